import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mortar.llm import ranges, records, scratch
from tests.llm.fixtures import documents, empty

PATH = public_tokenizers.path("word_bpe_49k.json")


def slow_crc32c(data):
    state = 0xFFFFFFFF
    for byte in data:
        state ^= byte
        for _ in range(8):
            state = (state >> 1) ^ 0x82F63B78 if state & 1 else state >> 1
    return state ^ 0xFFFFFFFF


def test_checksums():
    rng = np.random.default_rng(1)
    parts = [rng.bytes(n) for n in (0, 1, 2, 3, 1023, 1024, 1025, 2048, 3001)] + [b"123456789"]
    assert records.crc32c(parts).tolist() == [slow_crc32c(p) for p in parts]
    assert records.crc32c([b"123456789"])[0] == 0xE3069283


def test_broken_records_are_found():
    whole = b"".join(records.frame([b"one", b"", b"three"]))
    assert [p for batch in records.read_records(io.BytesIO(whole)) for p in batch] == [b"one", b"", b"three"]
    for broken in (whole[:-1], whole[:20], whole[:13] + b"X" + whole[14:], b"\x01" + whole[1:]):
        with pytest.raises(ValueError):
            list(records.read_records(io.BytesIO(broken)))


@pytest.mark.parametrize("rows", [4096, 25])
def test_round_trip(spark, monkeypatch, rows):
    monkeypatch.setattr(ranges.cut_points, "__defaults__", (rows, 2000))
    docs = documents(spark)
    library = Tokenizer.from_file(PATH)
    coded = []
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        coded.append((-1 if r["doc_id"] is None else r["doc_id"], ids))
    got = sorted(map(tuple, records.round_trip(docs, PATH).collect()), key=lambda r: r[1])
    assert [-1 if r[0] is None else r[0] for r in got] == sorted(i for i, _ in coded)
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
    want = sorted((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in coded)
    assert sorted((-1 if r[0] is None else r[0], r[2], r[3]) for r in got) == want


def test_index_leads_to_single_records(spark):
    folder = scratch.fresh_path(spark, "records")
    index = records.write(documents(spark, real=False), folder, PATH)
    row = index.filter("doc_id = 9004").first()
    system, base = scratch.file_system(folder)
    with system.open_input_file(f"{base}/{row['file']}") as f:
        f.seek(row["at"])
        payload = next(iter(records.read_records(f)))[0]
    assert np.frombuffer(payload, "<u2").tolist()[-1] == records.END_ID
    assert len(payload) == row["bytes"]


def test_empty_table(spark):
    assert records.round_trip(empty(spark), PATH).count() == 0
