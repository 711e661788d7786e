"""Phrase mining, byte-level BPE and ranked search against plain versions."""

import base64
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from moodlake.llm import byte_pairs, phrases, ranked
from moodlake.llm.queries import tokenizer_path
from moodlake.llm.quotient import Layout

SF = "/root/testdata/sf0.001"
RANKS = tokenizer_path("byte_bpe_50k.tiktoken")


def _table(spark, rows, schema="doc_id long, text string, lang string"):
    """Rows with further columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, schema)
    for name in ("t", "shard", "ids", "term", "score", "rank", "n", "block"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame


@pytest.mark.parametrize("n,bits", [(2, 1), (2, 17), (2, 32), (3, 5), (3, 22), (3, 32), (4, 3), (4, 16), (4, 17), (4, 32)])
@pytest.mark.parametrize("parts", [1, 7])
def test_quotient_filter_loses_nothing(n, bits, parts):
    draw = np.random.default_rng(n * 100 + bits)
    words = [draw.integers(0, 1 << bits, 5000) for _ in range(n)]
    words = [np.concatenate([w, w[:400], np.full(300, w[0])]) for w in words]
    lay = Layout(n, bits)
    left, right, counts, place = lay.count(*lay.permute(*lay.pack(words)))
    got = Counter()
    ranges = lay.ranges(left, parts)
    assert (np.diff(ranges) >= 0).all() and ranges.max() < parts
    for r in range(parts):
        of = np.flatnonzero(ranges == r)
        if len(of):
            a, b, c = lay.read(lay.write(left[of], right[of], counts[of], parts))
            assert (a == left[of]).all() and (b == right[of]).all()
            for key, f in zip(zip(*(w.tolist() for w in lay.unpack(*lay.restore(a, b)))), c.tolist()):
                got[key] += f
    assert got == Counter(zip(*(w.tolist() for w in words)))
    assert (left[place] == lay.permute(*lay.pack(words))[0]).all()


def _phrases(rows, least, top):
    grams, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for m in range(1, 5):
                grams[lang or "und"].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in grams.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {p[i : i + m] for p, a in found.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= 80 * f[p[i : i + m]]}
        scored = []
        for p, a in found.items():
            if p not in gone:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, x, y) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, x, y, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("shard_bytes", [700, 1 << 24])
def test_phrases(spark, shard_bytes):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    odd = [
        (None, None, None), (1, "", "en"), (2, "a a a a a a a", None), (2, "a a a a a a a", None), (3, "É É. É É É,x\ty\x0bx y  x\x00 y", "zz"),
        (4, " \t\n", "zz"), (5, "w" * 5000 + " " + "w" * 5000, "zz"), (5, "x y x y x y x y", "zz"), (6, "K a b  ", "en"),
    ]
    rows = docs + odd + [(9, "one two three four five. " * 4, "en")] * 3
    for least, top in ((3, 5), (5, 100_000)):
        got = phrases.collocations(_table(spark, rows).repartition(3), least=least, top=top, shard_bytes=shard_bytes)
        assert sorted(tuple(r) for r in got.collect()) == _phrases(rows, least, top)


def test_phrases_of_nothing(spark):
    for rows in ([], [(1, None, None)], [(1, "only once", "en")]):
        assert phrases.collocations(_table(spark, rows)).collect() == []


def _library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_pairs(spark):
    draw, library = random.Random(7), _library()
    letters = lambda n, of: "".join(draw.choice(of) for _ in range(n))
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    odd = [
        None, "", " ", "   ", "a", "a" * 4001, "ab" * 900, "-" * 3000, "=-" * 500, "0123456789" * 90, "the" * 700, "漢字かな" * 300,
        letters(3000, "abcdefghijklmnopqrstuvwxyz"), letters(3000, "abcXYZ019+/="), "don't we'll I'm ", "🙂é☃ " * 40, "<|endoftext|>" * 9,
        "\x1c \x1d a\x85 b　 c  d", *(letters(draw.randrange(1, 16), " \n\t\r 　ab1.'é") for _ in range(400)),
    ]
    rows = docs + [(5, t) for t in odd] + [(None, "x y")]
    frame = _table(spark, [(i, t, "en") for i, t in rows]).repartition(2)
    got = byte_pairs.encode(frame, RANKS, public_tokenizers.PATTERN)
    want = sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert sorted((str(r.doc_id), list(r.ids), bytes(r.decoded)) for r in got.collect()) == want
    again = byte_pairs.decode(got.drop("decoded"), RANKS, public_tokenizers.PATTERN)
    assert sorted((str(r.doc_id), list(r.ids), bytes(r.decoded)) for r in again.collect()) == want
    assert byte_pairs.encode(frame.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []
    nothing = byte_pairs.decode(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>"), RANKS, public_tokenizers.PATTERN)
    assert {r.doc_id: r.decoded for r in nothing.collect()} == {1: None, 2: b""}


def test_byte_pairs_with_small_windows(monkeypatch):
    """Long pre-tokens are spliced the same at any window size, and by widening where need be."""
    draw, library = random.Random(3), _library()
    use = byte_pairs.byte_pairs(RANKS, public_tokenizers.PATTERN)
    monkeypatch.setattr(byte_pairs, "LONG", 12)
    raw = ["".join(draw.choice(of) for _ in range(draw.randrange(13, 200))) for of in ("ab", "the", "abcdefghij", "=-", "0") for _ in range(60)]
    for overlap in (2, 7):
        # Merging alone: a whole pre-token that is a token is not what windows are for.
        assert [use.encode_long(r.encode(), overlap) for r in raw] == use.contract([r.encode() for r in raw])
    long = [r for r in raw if r.encode() not in use.whole]
    merged = [np.frombuffer(x, "<i4").tolist() for x in use.contract([r.encode() for r in long])]
    assert merged == [library.encode_ordinary(r) for r in long]


def _ranked(docs, items, top):
    def cut(text):
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text)

    held = [(i, Counter(cut(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 100 - 25 + (25 * c.total() * n_docs) // n_terms
            score = sum(weight[t] * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in cut(text) if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(str(item), k, None if gone else i, -s) for k, (s, gone, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_docs,block_bytes,top", [(7, 1 << 20, 20), (64, 300, 3), (1 << 15, 1 << 20, 20)])
def test_ranked_search(spark, shard_docs, block_bytes, top):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(900 + k, docs[3][1]) for k in range(30)] + [(901, docs[3][1]), (None, docs[3][1]), (None, docs[4][1]), (None, None)]
    docs += [(1000, ""), (1001, "., \n"), (1002, "Straße ÉCOLE école 漢字 x1"), (1003, docs[5][1][:50] * 200), (1004, None)]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()][:12]
    items += [(50, docs[3][1][:300]), (50, docs[3][1][:300]), (51, None), (52, ""), (53, "nowhere1 nowhere2"), (None, "École straße 漢字"), (54, "the")]
    items += [(55, docs[7][1] + " " + docs[8][1])]
    table = _table(spark, [(i, t, "en") for i, t in docs]).repartition(4)
    asked = _table(spark, [(i, t, "en") for i, t in items], "item_id long, text string, lang string")
    got = ranked.ranked_search(table, asked, top=top, shard_docs=shard_docs, block_bytes=block_bytes)
    rows = sorted(((str(r.item_id), r["rank"], r.doc_id, r.score) for r in got.collect()), key=str)
    assert rows == _ranked(docs, items, top)


def test_ranked_search_of_nothing(spark):
    some = _table(spark, [(1, "a b", "en")])
    none = some.limit(0)
    items = some.withColumnRenamed("doc_id", "item_id")
    assert ranked.ranked_search(none, items).collect() == []
    assert ranked.ranked_search(some, items.limit(0)).collect() == []
    assert ranked.ranked_search(_table(spark, [(1, ".", "en"), (2, None, "en")]), items).collect() == []


def test_pair_bound_is_below_the_sum_of_maxima(spark):
    """Terms that never meet are bounded by the larger of both, and the search uses it."""
    rows = [(k, "alpha " * (1 + k % 3) if k % 2 else "beta " * (1 + k % 3)) for k in range(100)]
    building = ranked._Building()
    numbers = {b"alpha": 0, b"beta": 1}
    for i, t in rows:
        building.add(str(i), t, numbers)
    frame = building.rows(0)
    row = next(r for r in frame.itertuples(index=False) if r.ids is not None)
    shard = ranked.Shard(row, ranked.Queries(["alpha beta"], numbers, 100, sum(len(t.split()) for _, t in rows), {0: 50, 1: 50}))
    joint, docs = shard.pair(0, 1, 1, 1)
    assert joint == 0 and len(docs) == 0
    found, scores = shard.search(Counter({0: 1, 1: 1}), max(shard.most.values()) + 1, 20)
    assert len(found) == 0
