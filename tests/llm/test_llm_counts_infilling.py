import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import by_id

from moldwise.llm import infilling, token_counts
from moldwise.llm.textbytes import text_bytes


@pytest.fixture(scope="module")
def path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def test_counts_equal_library(edge_docs, edge_rows, plain):
    got = token_counts.count_report(edge_docs)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = {}
    for i, text in edge_rows:
        n = len(plain.encode(text or "", add_special_tokens=False).ids)
        want.setdefault(i, []).append((len((text or "").encode()), n, n > 1024))
    assert {i: sorted(v) for i, v in by_id(got.collect(), 1, 2, 3).items()} == {i: sorted(v) for i, v in want.items()}


def test_counts_of_no_rows(no_docs):
    assert token_counts.count_report(no_docs).count() == 0


PIECES = ["The", "cat", "'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'S", "'", "''", " ", "  ", "\n", "\r\n", "\t", "!", "!!", "…", "a", "s", "1", "22", "½", "٣", "<|endoftext|>", "<|endof", "é", "é", "日本", "　", " ", "\x1c", "\x85", "\x00", "𝔘", "ǅ", "​", "'re's", "r", "l", "_", "-", "Ⅷ", "²"]


def test_odd_texts_one_by_one(path, plain):
    rng = random.Random(4)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(20000)]
    want = [len(e) for e in plain.encode_batch_fast(texts, add_special_tokens=False)]
    splitter = token_counts.PreTokens(path)
    for table in (token_counts.LengthTable(4), token_counts.LengthTable(4)):  # the second time, the worker's table has them
        assert splitter.count(*text_bytes(pa.array(texts)), table).tolist() == want


def test_tables_that_overflow(path, plain):
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abcdef") for _ in range(rng.randint(1, 7))) for _ in range(400)) for _ in range(8)]
    splitter = token_counts.PreTokens(path)
    splitter.cache = token_counts.LengthTable(100)  # starts anew again and again
    for text in texts:
        assert splitter.count(*text_bytes(pa.array([text])), token_counts.LengthTable(1)).tolist() == [len(plain.encode(text).ids)]
    table = token_counts.LengthTable(1000)
    key, check = (np.array([rng.getrandbits(64) & 0xFF000000000000FF for _ in range(800)], np.uint64) for _ in range(2))  # many share a slot
    pairs = np.unique(np.stack([key, check], axis=1), axis=0)
    table.add(pairs[:400, 0], pairs[:400, 1], np.arange(1, 401))
    assert table.find(pairs[:, 0], pairs[:, 1]).tolist() == [*range(1, 401), *[0] * (len(pairs) - 400)]


def test_long_texts_go_block_by_block(path, plain, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE_BYTES", 2000)
    rng = random.Random(6)
    text = "".join(rng.choice(PIECES + [" word"] * 30) for _ in range(8000)) + "y" * 9000 + " <|endoftext|>\n" + "z" * 3000
    splitter = token_counts.PreTokens(path)
    assert splitter.count(*text_bytes(pa.array([text])), token_counts.LengthTable(4)).tolist() == [len(plain.encode(text, add_special_tokens=False).ids)]
    data = text_bytes(pa.array([text]))[0]
    parts = list(token_counts.blocks(data, 2000))
    assert len(parts) > 10 and b"".join(p.tobytes() for p in parts) == text.encode()


def test_frequent_lengths_are_a_bounded_table(spark, path, plain):
    docs = spark.createDataFrame([(i, f"often rare{i} often") for i in range(300)], "doc_id long, text string").repartition(4)
    table = token_counts.frequent_lengths(docs, path, entries=5, tasks=2)
    assert table.used == 5
    data = np.frombuffer(b" often", np.uint8)
    _, key, check = token_counts.PreTokens(path).hashes(data, np.array([0]))
    assert table.find(key, check).tolist() == [len(plain.encode(" often").ids)]


def test_frequent_lengths_are_of_all_texts(spark, path, plain, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE_BYTES", 4000)
    head = " ".join(f"early{i}" for i in range(400_000))  # over the first megabyte of the only partition
    docs = spark.createDataFrame([(0, head), (1, " late" * 30 + "<|endoftext|> late"), (2, None), (3, ""), (4, " later")], "doc_id long, text string").coalesce(1)
    splitter = token_counts.PreTokens(path)

    def found(table, word):
        _, key, check = splitter.hashes(np.frombuffer(word, np.uint8), np.array([0]))
        return table.find(key, check).tolist()

    table = token_counts.frequent_lengths(docs, path, entries=2)  # behind " early"; numbers come once each
    assert found(table, b" late") == [len(plain.encode(" late").ids)]


def test_tallies_count_every_pre_token(path, plain, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE_BYTES", 3000)
    rng = random.Random(7)
    texts = ["".join(rng.choice(PIECES + [" word"] * 9) for _ in range(n)) for n in (0, 5, 300, 9000, 40)]
    splitter, held = token_counts.PreTokens(path), []
    for some in (texts[:3], texts[3:4], texts[4:]):
        held += list(splitter.tally(*text_bytes(pa.array(some))))
    key, check, length, times = token_counts._merged(held)
    assert len(held) > 5 and len(np.unique(np.stack([key, check], axis=1), axis=0)) == len(key)
    added = sum(len(splitter.pattern.findall(t.encode())) for t in texts)
    assert int((length * times).sum()) + added == sum(len(plain.encode(t, add_special_tokens=False).ids) for t in texts)


def plain_infilling(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    sha = hashlib.sha256(text.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, sha, sha
    one, two, three = text[:a], text[a:b], text[b:]
    form, out = ("spm", f"<S>{three}<P>{one}<M>{two}") if h[3] % 100 < 20 else ("psm", f"<P>{one}<S>{three}<M>{two}")
    return n, form, a, b - a, hashlib.sha256(out.encode()).hexdigest(), sha


def test_infilling_equals_plain_version(spark, edge_rows, no_docs):
    from conftest import frame

    rng = random.Random(8)
    rows = edge_rows + [(100 + i, "".join(rng.choice(["<", "P", "S", "M", ">", "é", "𝔘", " ", "\n"]) for _ in range(rng.randint(0, 30)))) for i in range(200)]
    rows += [(400, "has <P> inside"), (401, "<M>"), (402, "<S"), (403, "x" * 200_000 + "é" * 100_000)]
    got = infilling.infilling_report(frame(spark, rows).repartition(3))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    want = {}
    for i, text in rows:
        want.setdefault(i, []).append(plain_infilling(i, text))
    assert {i: sorted(v, key=str) for i, v in by_id(got.collect(), 1, 2, 3, 4, 5, 6).items()} == {i: sorted(v, key=str) for i, v in want.items()}
    assert infilling.infilling_report(no_docs).count() == 0


def test_skip_list_reaches_every_rank():
    rng = random.Random(9)
    for _ in range(200):
        points = np.array([rng.randint(1, 9) for _ in range(rng.randint(1, 600))])
        steps = infilling.SkipList(np.ones(len(points), int), points, rng.getrandbits(60))
        places = np.append(0, np.cumsum(points)).tolist()
        assert [steps.descend(r) for r in range(len(places))] == list(enumerate(places))
    for lane, above in zip(steps.lanes, steps.lanes[1:]):
        assert sum(lane[0]) == sum(above[0]) and sum(lane[1]) == sum(above[1]) and len(above[0]) < len(lane[0])
    for n in (1, 63, 64, 65, 1000):
        assert infilling.cut_ranks("é" * n, list(range(n + 1)), None, 3) == list(range(n + 1))


def test_units_by_pattern(spark):
    assert infilling.cut_ranks("  ab  cd e", [0, 1, 2, 3], r"\S+", 1) == [0, 6, 9, 10]
    assert infilling.cut_ranks("   ", [0, 1], r"\S+", 1) == [0, 3]
    docs = spark.createDataFrame([(i, "one two three four " * 5) for i in range(40)], "doc_id long, text string")
    rows = infilling.fill_in_middle(docs, r"\S+\s*").collect()
    cut = [r for r in rows if r["fim_form"] != "plain"]
    assert len(cut) > 20 and all(r["fim_n"] == 20 and r["text"][: r["fim_prefix_chars"]].endswith((" ", "")) for r in cut)
    assert all(r["fim_prefix_chars"] in {0, *(i + 1 for i, c in enumerate(r["text"]) if c == " ")} for r in cut)
