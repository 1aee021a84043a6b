import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from moldwise.llm import eliasfano, language, ngram_lm, quality, segment, toxicity
from moldwise.llm.textbytes import SPACED, Words, grams, mix, text_bytes

SF = "/root/testdata/sf0.01"


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n if i is not None else None


def labelled(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels


def test_words_and_hashes(edge_rows):
    texts = [t for _, t in edge_rows]
    words = Words(*text_bytes(pa.array(texts)), SPACED)
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert words.counts.tolist() == [len(w) for w in want]
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for ws in want for w in ws]
    for k, flat in ((0, low), (1, low), (2, [w for ws in want for w in ws])):
        h = words.hashes(k).tolist()
        assert len({*zip(h, flat)}) == len(set(h)) == len(set(flat))
    assert len(grams(words.hashes()[:3], 5)) == 0


def test_elias_fano():
    rng = np.random.default_rng(1)
    for u, n in [(1 << 40, 1000), (5000, 900), (1 << 63, 50), (10, 10), (1, 0)]:
        v = np.unique(rng.integers(0, u, n, dtype=np.uint64)) if n else np.empty(0, np.uint64)
        seq = eliasfano.EliasFano(eliasfano.encode(v, u))
        q = np.concatenate([v, rng.integers(0, u, 500, dtype=np.uint64)])
        place = {int(x): i for i, x in enumerate(v)}
        assert seq.find(q).tolist() == [place.get(int(x), -1) for x in q]
        if n:
            assert (seq.get(np.arange(len(v))) == v).all()


def plain_model(rows):
    toks = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None] for _, t in rows]
    count = [Counter() for _ in range(3)]
    for (i, _), tk in zip(rows, toks):
        if fold(i, 10) != 0:
            for n in range(3):
                count[n].update(tuple(tk[k - n : k + 1]) for k in range(n, len(tk)))
    total, size = sum(count[0].values()), len(count[0])
    under, kinds = defaultdict(int), defaultdict(int)
    for n in (1, 2):
        for g, c in count[n].items():
            under[g[:-1]] += c
            kinds[g[:-1]] += 1
    out = []
    for (i, _), tk in zip(rows, toks):
        base = score = known = 0
        for j, w in enumerate(tk):
            known += count[0][(w,)] > 0
            p = (count[0][(w,)] + 0.1) / (total + 0.1 * (size + 1))
            base += math.log10(p)
            for n in (1, 2):
                h = tuple(tk[j - n : j]) if j >= n else None
                if h and kinds[h]:
                    p = (count[n][(*h, w)] + kinds[h] * p) / (under[h] + kinds[h])
            score += math.log10(p)
        out.append((i, fold(i, 10) == 0, len(tk), known, total, base, score))
    return sorted(out, key=str)


def test_trie_scores_equal_plain_version(edge_docs, edge_rows, no_docs):
    got = sorted((tuple(r) for r in ngram_lm.scoring_report(edge_docs).collect()), key=str)
    for g, w in zip(got, plain_model(edge_rows), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], abs=1e-6) and abs(g[6] - w[6]) <= 0.03 * w[2]
    assert ngram_lm.scoring_report(no_docs).count() == 0


def test_trie_children(spark, edge_docs):
    trie = ngram_lm.train(edge_docs)
    for n in (2, 3):
        contexts = int(trie.levels[n - 2].nodes[-1])
        bounds = [trie.child_range(n, c) for c in range(0, contexts, max(1, contexts // 50))]
        assert all(a <= b for a, b in bounds)
        last = trie.child_range(n, contexts - 1)
        assert last[1] == trie.levels[n - 1].nodes[-1]
    # a context's shares and what it leaves make one, up to the codebooks
    words = np.arange(trie.words)
    for context in range(0, trie.words, max(1, trie.words // 20)):
        _, share, left = trie.children(2, np.full(trie.words, context), words)
        assert share.sum() + left[0] == pytest.approx(1, abs=0.05)


def test_forward_backward():
    rng = np.random.default_rng(0)
    model = language.Model(["a", "b", "c"], None, None, None, rng.normal(size=3), rng.normal(size=(3, 3)))
    sizes = [1, 5, 0, 300, 129, 128, 2]
    bounds = np.append(0, np.cumsum(sizes))
    scores = rng.normal(size=(bounds[-1], 3)) * 2
    got = language.marginals(model, scores, bounds)
    for a, b in zip(bounds[:-1], bounds[1:]):
        s, n = scores[a:b], b - a
        ahead, behind = np.zeros((n, 3)), np.zeros((n, 3))
        for i in range(n):
            ahead[i] = s[i] + (model.start if i == 0 else np.logaddexp.reduce(ahead[i - 1][:, None] + model.change, axis=0))
        for i in range(n - 2, -1, -1):
            behind[i] = np.logaddexp.reduce(model.change + (s[i + 1] + behind[i + 1])[None], axis=1)
        x = ahead + behind
        assert np.allclose(got[a:b], np.exp(x - np.logaddexp.reduce(x, axis=1)[:, None]) if n else x)
    s = scores[1:6]  # against all paths of a short text
    weight = {p: math.exp(model.start[p[0]] + sum(s[i][x] for i, x in enumerate(p)) + sum(model.change[x, y] for x, y in zip(p, p[1:]))) for p in product(range(3), repeat=5)}
    assert sum(w for p, w in weight.items() if p[2] == 1) / sum(weight.values()) == pytest.approx(got[3][1])


def test_language_held_out(spark):
    docs, _ = labelled(spark)
    got = language.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.97 and all(0 <= r["score"] <= 1 for r in got)


def test_language_inside_a_text(spark):
    docs, _ = labelled(spark)
    model = language.train(docs)
    texts = {r["lang"]: r["text"] for r in docs.where("lang in ('en', 'de') and n_chars between 1500 and 3000 and not text like '%|%'").collect()}
    best, share, other = language.predict(model, *text_bytes(pa.array([texts["en"], texts["de"], texts["en"] + " " + texts["de"]])))
    assert model.langs[best[0]] == "en" and model.langs[best[1]] == "de" and share[2] < 0.9 and other[2] > 50


def test_language_of_odd_texts(edge_docs, edge_rows, no_docs):
    got = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language.language_report(edge_docs).collect()}
    for i, t in edge_rows:
        has = any(c.isalpha() for c in t or "")
        assert any(g[0] == i and (g[1] == "en") == has and (g[1] == "und") == (not has) and (g[2] > 0) == has for g in got)
    assert language.language_report(no_docs).count() == 0
    unlabelled = language.language_report(edge_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}


def test_convolution_and_chunks():
    rng = np.random.default_rng(2)
    model = quality.Model(rng.normal(size=(256, quality.DIM)).astype("f4"), rng.normal(size=(64, quality.FILTERS)).astype("f4"), rng.normal(size=quality.FILTERS).astype("f4"), rng.normal(size=quality.FILTERS), 0.3)
    texts = ["", "short", "y" * 256, "z" * 257, "".join(map(chr, rng.integers(32, 126, 1500)))]
    got = quality.score(model, *text_bytes(pa.array(texts)))[0]
    for text, score in zip(texts, got):
        raw = text.encode()
        halves = max(1, -(-len(raw) // 256))
        raw += b"\0" * (halves * 256 - len(raw))
        at = [model.embed[list(raw[i : i + 8])].ravel() @ model.filters + model.shift for i in range(halves * 256 - 7)]
        tops = [np.maximum(0, np.max(at[h * 256 : h * 256 + 256], axis=0)) for h in range(halves)]
        chunks = [np.maximum(tops[c], tops[min(c + 1, halves - 1)]) @ model.weights + model.bias for c in range(max(1, halves - 1))]
        assert score == pytest.approx(1 / (1 + math.exp(-np.mean(chunks))), rel=1e-4)
    assert len(got) == 5 and ((got >= 0) & (got <= 1)).all()


def test_texts_do_not_touch(spark, edge_rows):
    docs, labels = labelled(spark)
    model = quality.train(docs, labels)
    texts = [r["text"] for r in docs.collect()] + [t for _, t in edge_rows] + ["x" * 256, "y" * 249, "z" * 512]
    alone = np.array([quality.score(model, *text_bytes(pa.array([t], pa.string())))[0][0] for t in texts])
    together = quality.score(model, *text_bytes(pa.array(texts, pa.string())))[0]
    order = np.random.default_rng(3).permutation(len(texts))
    shuffled = quality.score(model, *text_bytes(pa.array([texts[i] for i in order], pa.string())))[0]
    assert np.abs(alone - together).max() < 1e-6 and np.abs(alone[order] - shuffled).max() < 1e-6


def accuracy(got, labels, column):
    known = {r["doc_id"]: r[column] for r in labels.collect()}
    held = [r for r in got if r["held_out"] and r["doc_id"] in known]
    return np.mean([r["predicted"] == known[r["doc_id"]] for r in held])


def test_quality_held_out(spark, edge_docs, edge_rows, no_docs):
    docs, labels = labelled(spark)
    assert accuracy(quality.quality_report(docs, labels).collect(), labels, "quality") > 0.88
    some = labels.select("doc_id", "quality", F.lit("x").alias("text"), F.lit(1).alias("score"))
    got = quality.quality_report(edge_docs, some.unionByName(some)).collect()
    assert len(got) == len(edge_rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    assert quality.quality_report(no_docs, labels).count() == 0
    assert quality.quality_report(edge_docs, labels.where("false")).count() == len(edge_rows)


def test_toxicity_noisy_or(edge_rows):
    texts = [t for _, t in edge_rows]
    data, offsets = text_bytes(pa.array(texts))
    words = Words(data, offsets, toxicity.ALNUM)
    vocabulary = np.unique(words.hashes())[::3]
    weights = np.random.default_rng(1).normal(size=len(vocabulary))
    got = toxicity.score(toxicity.Model(vocabulary, weights, -3.0), data, offsets)
    table = dict(zip(vocabulary.tolist(), weights))
    spelled = {bytes(data[s:e]): table.get(h, 0.0) for s, e, h in zip(words.start, words.end, words.hashes().tolist())}
    for text, p, n in zip(texts, got[0], got[1]):
        parts = [set(re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", part)) for part in re.split(rb"[\n!.?]", (text or "").encode())]
        parts = [{w.lower() if w.isascii() else w for w in part} for part in parts if part]
        low = {k.lower() if k.isascii() else k: v for k, v in spelled.items()}
        chance = [1 / (1 + math.exp(3.0 - sum(low[w] for w in part))) for part in parts]
        assert n == len(parts) and p == pytest.approx(1 - math.prod(1 - c for c in chance), abs=1e-9)


def test_toxicity_held_out(spark, edge_docs, edge_rows, no_docs):
    docs, labels = labelled(spark)
    assert accuracy(toxicity.toxicity_report(docs, labels).collect(), labels, "toxic") > 0.9
    got = toxicity.toxicity_report(edge_docs, labels).collect()
    assert len(got) == len(edge_rows) and all(r["score"] == 0 and r["worst_start"] == -1 for r in got if r["doc_id"] in (1, 2, 3))
    assert toxicity.toxicity_report(no_docs, labels).count() == 0
    assert toxicity.toxicity_report(edge_docs, labels.where("false")).count() == len(edge_rows)


def test_toxicity_finds_the_sentence():
    rng = np.random.default_rng(3)
    words = ["w%d" % i for i in range(60)]
    say = lambda: " ".join(rng.choice(words, 8)) + "."
    labels = rng.integers(0, 2, 400)
    texts = [" ".join([say(), say(), say().replace(".", " vile.") if y else say(), say()]) for y in labels]
    model = toxicity.fit(texts, labels)
    probe = "w1 w2 w3. w4 vile w5. w6 w7"
    p, n, bad, start, end = (x[0] for x in toxicity.score(model, *text_bytes(pa.array([probe]))))
    assert p > 0.5 and n == 3 and bad == 1 and probe.encode()[start:end] == b"w4 vile w5"


def test_toxicity_of_joined_clean_texts(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    held = labels.where("toxic is not null").join(docs, "doc_id").where(toxicity.is_fold(F.col("doc_id"), toxicity.FOLDS, toxicity.HELD_OUT)).orderBy("doc_id").select("text", "toxic").collect()
    clean, toxic = ([r["text"] for r in held if r["toxic"] == label and r["text"]] for label in (0, 1))
    p, _, bad, start, end = toxicity.score(model, *text_bytes(pa.array(toxic)))
    found = [t.encode()[a:b].decode() for t, n, a, b in zip(toxic, bad, start, end) if n]
    assert np.mean(p >= 0.5) > 0.75 and len(found) > 50
    joined = ["\n".join(clean[i : i + 40]) for i in range(0, 720, 40)]
    assert (toxicity.score(model, *text_bytes(pa.array(joined)))[0] >= 0.5).sum() <= 1
    planted = [f"{text}\n{one}\n{text}" for text, one in zip(joined, found)]
    assert (toxicity.score(model, *text_bytes(pa.array(planted)))[0] >= 0.5).all()


def pieces():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def all_segmentations(table, text):
    raw = b" " + text.encode() if text else b""
    by = {table.data[table.start[i] : table.start[i] + n].tobytes(): int(i) for n, (_, ids) in table.by_size.items() for i in ids}

    def go(at):
        if at == len(raw):
            yield ()
            return
        char = raw[at:].decode()[0].encode()
        for n in table.by_size:
            if raw[at : at + n] in by and at + n <= len(raw):
                yield from ((by[raw[at : at + n]], *rest) for rest in go(at + n))
        if char not in by:
            yield from ((*(int(table.of_byte[b]) for b in char), *rest) for rest in go(at + len(char)))

    paths = list(go(0))
    weight = np.array([sum(table.weight[i] for i in p) for p in paths])
    return dict(zip(paths, np.exp(weight - np.logaddexp.reduce(weight))))


@pytest.mark.parametrize("text", ["the cat", "ab", "a\n☃b", ""])
def test_samples_without_replacement(text):
    table, n = segment.load(pieces()), 4000
    chance = all_segmentations(table, text)
    sampler = segment.Sampler(table, *text_bytes(pa.array([text] * n)), mix(np.arange(n, dtype=np.uint64) * np.uint64(77777) + np.uint64(5)))
    paths, left = sampler.search(3)
    drawn = [[tuple(sampler.ids(p).tolist()) for p in ps] for ps in paths]
    assert all(len(set(d)) == len(d) == min(3, len(chance)) for d in drawn)
    assert all(a.key > b.key > k for ps, k in zip(paths, left) for a, b in zip(ps, ps[1:]))
    assert all(math.exp(p.logs.sum()) == pytest.approx(chance[d]) for ps, ds in zip(paths[:50], drawn) for p, d in zip(ps, ds))
    for j in range(min(2, len(chance))):
        seen = Counter(d[j] for d in drawn)
        want = chance if j == 0 else {b: sum(pa_ * pb / (1 - pa_) for a, pa_ in chance.items() if a != b and pa_ < 1) for b, pb in chance.items()}
        assert max(abs(seen[k] / n - v) for k, v in want.items()) < 0.04
    total = [sum(math.exp(p.logs.sum() - segment.log_inclusion(float(p.logs.sum()), k)) for p in ps) for ps, k in zip(paths, left)]
    assert np.mean(total) == pytest.approx(1, abs=0.03)  # inclusion scores make unbiased sums


def test_segmentations_decode(edge_docs, edge_rows, no_docs):
    got = segment.segmentations(edge_docs, pieces(), k=2).collect()
    assert {r["doc_id"] for r in got} == {i for i, _ in edge_rows} and all(r["decoded"] for r in got)
    again = {(r["doc_id"], r["n_pieces"], r["ids_crc32"]) for r in segment.segmentation_report(edge_docs.repartition(1)).collect()}
    assert again == {(r["doc_id"], r["n_pieces"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in got}
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces())
    texts = {t for _, t in edge_rows if t and "▁" not in t and "\x00" not in t}
    assert {model.decode(r["ids"]) for r in got} >= texts
    assert segment.segmentations(no_docs, pieces()).count() == 0
