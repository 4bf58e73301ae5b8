"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 30


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text, modulo 5, is 0 (as for no id)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample_by(
    rows: DataFrame, label: str, per_label: int, max_chars: int, texts: DataFrame | None = None
) -> tuple[list, dict]:
    """About ``per_label`` rows (label, text) of each label, and the label's count of rows.

    Rows are drawn by a hash of the id, so the driver gets a bounded expected number whatever the
    table's size; of those drawn, texts of more than ``max_chars`` characters are left out.  With
    ``texts`` (``doc_id``, ``text``) only the drawn ids are sent to meet the texts.
    """
    known = rows.where(F.col(label).isNotNull())
    if texts is None:
        known = known.where(F.char_length("text") <= max_chars)
    counts = {r[0]: r[1] for r in known.groupBy(label).count().collect()}
    if not counts:
        return [], {}
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(2**_BITS * min(1.0, per_label / n)))])
    drawn = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(2**_BITS)) < F.element_at(share, F.col(label))
    found = known.where(drawn)
    if texts is not None:
        short = texts.where(F.char_length("text") <= max_chars)
        found = short.join(F.broadcast(found.select("doc_id", label)), "doc_id")
    found = found.select("doc_id", label, "text").collect()
    found.sort(key=lambda r: (str(r[1]), r[0] or 0, r[2]))
    return [(r[1], r[2]) for r in found], counts
