import struct
import zlib

import numpy as np
import pytest
from conftest_llm import by_id

from moldwise.llm import sharding, token_records


def plain_shards(rows, shards=24):
    recs = sorted(((zlib.crc32((t or "").encode()), (i is not None, i or 0), len((t or "").encode()) + 8, i) for i, t in rows), key=lambda r: r[:2])
    total, run, out, slots = sum(r[2] for r in recs), 0, [], {}
    for crc, _, size, i in recs:
        shard = min(shards - 1, (2 * run + size) * shards // (2 * total))
        out.append((i, size, crc, shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
        run += size
    return sorted(out, key=str)


@pytest.mark.parametrize("ranges, draws", [(192, 16), (3, 1), (1, 1)])
def test_shards_equal_plain_version(edge_docs, edge_rows, ranges, draws):
    got = sharding.sharded(edge_docs.select("doc_id", "text"), ranges=ranges, draws=draws).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_shards(edge_rows)


def test_sharding_report_of_equal_rows_and_none(spark, no_docs):
    got = sharding.sharding_report(spark.createDataFrame([(7, "same")] * 200, "doc_id long, text string")).collect()
    by_shard = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(by_shard) == list(range(24)) and all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    empty = sharding.sharding_report(no_docs)
    assert empty.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"] and empty.count() == 0


def test_records_round_trip(spark, edge_docs, edge_rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = sorted((tuple(r) for r in token_records.token_report(edge_docs).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((i for i, _ in edge_rows), key=lambda i: (i is not None, i or 0))
    want = {}
    for i, t in edge_rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [2]
        want.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert {i: sorted(v) for i, v in by_id(got, 2, 3).items()} == {i: sorted(v) for i, v in want.items()}
    start = 0
    for r in got:
        assert r[1] == start
        start += r[2]


def test_records_of_no_rows(no_docs):
    assert token_records.token_report(no_docs).count() == 0


def test_frames_and_damage(tmp_path):
    ids = np.array([1, 70000, 2], np.uint32)
    data = token_records.record(5, ids) + token_records.record(None, ids[:1])
    assert struct.unpack("<Q", data[:8])[0] == 9 + 12
    doc, back, at = token_records.parse(memoryview(data), 0)
    assert doc == 5 and back.tolist() == ids.tolist()
    assert token_records.parse(memoryview(data), at)[0] is None
    for spot in (0, 9, 14, at - 1):
        broken = bytearray(data)
        broken[spot] ^= 1
        with pytest.raises(ValueError):
            token_records.parse(memoryview(bytes(broken)), 0)
    (tmp_path / "f.rec").write_bytes(data)
    (tmp_path / "f.idx").write_bytes(np.array([0, at], "<u8").tobytes())
    assert token_records.read_at(str(tmp_path), "f", 1)[1].tolist() == [1]


def test_units_encode_like_whole_texts():
    import random

    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer

    from moldwise.llm.textbytes import text_bytes

    path = public_tokenizers.path("word_bpe_49k.json")
    plain, units = Tokenizer.from_file(path), token_records.UnitIds(path)
    rng = random.Random(3)
    parts = ["The", "cat", "it's", "'s", "''ll", ",'s", "!!", "…", "a,b", "x1y22", "<|endoftext|>", "<|EndOfText|>z", "<", "|>", "H\u0331", "h\u0331", "Éa", "İx", "日本", "\u3000", "\u00a0", "\u0301", "é,\u0301", "-", "@", "_", " ", "\n", "\x1c", "\x00", "ǅ", "ﬁ", "ß", "I'VE", "o'Re"]
    texts = ["".join(rng.choice(parts) + (" " if rng.random() < 0.4 else "") for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    ids, count = units.encode(*text_bytes(pa.array(texts)))
    at = 0
    for text, n in zip(texts, count.tolist()):
        assert ids[at : at + n].tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)
        at += n
