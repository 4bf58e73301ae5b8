"""Code lists kept as small text files: one code, or the words of one row, a line."""

from __future__ import annotations

from functools import cache
from pathlib import Path

AREA_CODES = str(Path(__file__).resolve().parent / "data" / "area_codes.txt")
STATE_ZIP = str(Path(__file__).resolve().parent / "data" / "state_zip.txt")


@cache
def read_codes(path: str) -> list[tuple[str, ...]]:
    """Rows of a code list on the driver's disk; lines that begin with ``#`` are remarks."""
    lines = Path(path).read_text(encoding="utf-8").splitlines()
    return [tuple(line.split()) for line in lines if line.strip() and not line.startswith("#")]


def area_codes(path: str = AREA_CODES) -> list[str]:
    return [code for (code,) in read_codes(path)]
