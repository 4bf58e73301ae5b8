"""Few texts are encoded at a time, whatever an Arrow batch holds."""

import pyarrow as pa

from cardledger.llm import pieces


def test_a_batch_is_encoded_in_small_parts(monkeypatch):
    sizes, encode = [], pieces.PieceTokenizer.encode

    def counting(self, texts):
        sizes.append(len(texts))
        return encode(self, texts)

    monkeypatch.setattr(pieces.PieceTokenizer, "encode", counting)
    texts = [f"word {i} and more" for i in range(450)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(451), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    with open(pieces.MODEL, "rb") as file:
        out = pa.Table.from_batches(pieces._encoder(file.read(), 1)(iter([batch])))
    assert max(sizes) <= 100 and sum(sizes) == 451 == out.num_rows
    assert all(out.column("parity").to_pylist()) and all(out.column("round_trip").to_pylist())
    assert out.column("doc_id").to_pylist() == list(range(451))
