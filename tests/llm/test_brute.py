"""Operators against plain versions of what they compute."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from moodlake.llm import decontaminate, fingerprints, language, pieces, pii, quality, repeats, simhash_dedup, token_counts
from moodlake.llm.common import connected_components
from moodlake.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def _repeated(texts: dict) -> dict:
    raw = {k: t.encode() for k, t in texts.items()}
    seen = collections.Counter(b[i : i + 200] for b in raw.values() for i in range(len(b) - 199))
    out = {}
    for k, b in raw.items():
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not p for p, g in zip(b"\0" + bytes(gone), gone))
        out[k] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_repeated_bytes(docs, texts):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.repeated_bytes(docs).collect()}
    assert got == _repeated(texts)


@pytest.mark.parametrize("flush", [1, 3000, 150_000])
def test_repeated_bytes_shifted_passages(spark, monkeypatch, flush):
    """Crowded anchors, overlaps, periodic texts, one-byte edits, windows at both ends."""
    monkeypatch.setattr(repeats, "FLUSH", flush)
    draw = random.Random(5)
    letters = lambda n, of="abcdefgh ": "".join(draw.choice(of) for _ in range(n))
    passage = letters(700)
    made = {}
    for i in range(60):
        cut = draw.randrange(0, 400)
        made[i] = letters(draw.randrange(0, 150)) + passage[cut : cut + draw.randrange(150, 330)] + letters(draw.randrange(0, 150))
    for i in range(60, 80):
        edited = list(passage)
        for _ in range(3):
            edited[draw.randrange(700)] = "Z"
        made[i] = "".join(edited)
    made |= {80: "ab" * 400, 81: "ab" * 150 + "c", 82: "y" * 199, 83: "y" * 200, 84: "y" * 201, 85: passage, 86: letters(900, "ab")}
    frame = spark.createDataFrame(list(made.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.repeated_bytes(frame).collect()}
    assert got == _repeated(made)


def test_token_counts_with_any_chunk(spark, docs, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    odd = {-1: "a" * 5000, -2: " " * 3000 + "x" + " " * 500, -3: "<|endoftext|>" * 300, -4: "don't we'll " * 400, -5: "é☃漢字🙂" * 500, -6: "1 2" * 900}
    every = texts | odd
    want = {k: len(library.encode(t, add_special_tokens=False).ids) for k, t in every.items()}
    frame = spark.createDataFrame(list(every.items()), "doc_id long, text string")
    for chunk, overlap in ((700, 40), (1 << 20, 10)):
        counted = token_counts.token_counts(frame, tokenizer_path("byte_bpe_50k.json"), chunk=chunk, overlap=overlap)
        assert {r.doc_id: r.n_tokens for r in counted.collect()} == want


def test_edited_fingerprints(docs, texts):
    order = sorted(texts, reverse=True)
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs).collect()}
    for k, i in enumerate(order):
        half = len(texts[i]) // 2
        after = texts[order[(k + 1) % len(order)]]
        edited = texts[i][: len(texts[i]) - half] + after[:half]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        bits = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128
        assert got[i].near_next == bits(got[i].fingerprint, got[order[(k + 1) % len(order)]].fingerprint)
        assert got[i].near_edited == bits(got[i].fingerprint, got[i].edited_fingerprint)
    by_text = collections.defaultdict(set)
    for i, t in texts.items():
        by_text[t].add(got[i].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert np.mean([r.near_edited > r.near_next for r in got.values() if r.n_chars > 300]) > 0.95


@pytest.mark.parametrize("radius,blocks", [(3, 4), (2, 8), (7, 8)])
def test_within_radius_finds_all(spark, radius, blocks):
    draw = random.Random(radius)
    values = {draw.getrandbits(128) for _ in range(20)}
    for v in list(values):
        for _ in range(12):
            values.add(v ^ sum(1 << b for b in draw.sample(range(128), draw.randrange(0, radius + 3))))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(signed(v >> 64), signed(v & (1 << 64) - 1)) for v in values]
    frame = spark.createDataFrame(rows, "hi long, lo long")
    got = {(r.hi, r.lo, r.hi2, r.lo2) for r in fingerprints.within_radius(frame, frame, radius, blocks).collect()}
    mask = (1 << 64) - 1
    want = {(*a, *b) for a in rows for b in rows if ((a[0] ^ b[0]) & mask).bit_count() + ((a[1] ^ b[1]) & mask).bit_count() <= radius}
    assert got == want


def _simhash(text: str) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), text.encode()))
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(spark, docs, texts):
    extra = {1000 + i: texts[0] for i in range(3)} | {2000: texts[1] + " tail", 2001: "", 2002: " ", 2003: "One", 2004: "one two"}
    every = texts | extra
    frame = spark.createDataFrame(list(every.items()), "doc_id long, text string")
    prints = {k: _simhash(t) for k, t in every.items()}
    root = {k: k for k in every}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(every)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash_dedup.near_duplicates(frame).collect()}
    assert got == {k: (prints[k], find(k)) for k in every}
    kept = {r.doc_id for r in simhash_dedup.keep_one(frame.unionAll(frame.limit(5))).collect()}
    assert kept == {find(k) for k in every}


def test_links_reach_every_pair(spark):
    draw = random.Random(3)
    values = {0}
    while len(values) < 150:
        values.add(draw.choice(sorted(values)) ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(1, 6))))
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    edges = simhash_dedup.links(spark.createDataFrame([(s,) for s in signed.values()], "fp long"), 4)
    got = {r.node: r.component for r in connected_components(edges).collect()}
    for v in values:
        for w in values:
            if v < w and (v ^ w).bit_count() <= 4:
                assert got[signed[v]] == got[signed[w]]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {200: 200, 201: 200}


def _words(t):
    return re.findall(r"[^\W_]+", t.lower())


def test_decontaminate(spark, docs, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    one, two = list(items)[:2]
    edited = items[one].split()
    edited[len(edited) // 2] = "changed"
    planted = {5000: "start here " + items[two].upper() + " and so on", 5001: "so " + " ".join(edited) + " end", 5002: items[one][: len(items[one]) // 3]}
    frame = spark.createDataFrame(list((texts | planted).items()), "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.search(frame, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert got[5000].contaminated and two in got[5000].item_ids and got[5000].best == pytest.approx(1.0)
    assert got[5001].contaminated and one in got[5001].item_ids and got[5001].best < 1
    assert not got[5002].contaminated
    grams = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in items.items() for w in [_words(t)]}
    for d, t in texts.items():
        w = _words(t)
        own = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        assert got[d].contaminated == any(len(g & own) >= 0.8 * len(g) for g in grams.values())


def test_decontaminate_in_blocks(spark, docs, monkeypatch):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(decontaminate.search(docs, items).collect())
    plain = decontaminate.Index([(r.item_id, r.text) for r in items.collect()])
    assert {r.doc_id: r.item_ids for r in whole} == {r.doc_id: sorted(i for i, _ in plain.search(r.text)) for r in docs.collect()}
    kept = {r.doc_id for r in decontaminate.clean(docs, items).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 15)
    parts = sorted(decontaminate.search(docs, items).collect())
    assert [r[:3] + r[4:] for r in parts] == [r[:3] + r[4:] for r in whole]
    assert [r.best for r in parts] == pytest.approx([r.best for r in whole])
    assert {r.doc_id for r in decontaminate.clean(docs, items).collect()} == kept == {r.doc_id for r in whole if not r.contaminated}


def _every_window(index, text):
    """Best similarity of each item over the windows at all places of a text, each one looked at."""
    words, best = decontaminate.word_hashes(text), {}
    for i, (_, width, own) in enumerate(index.items):
        s = decontaminate.shingles(words, width)
        for p in range(len(s)):
            part = s[p : p + len(own)]
            w = index.weights(part)
            value = index.similarity(i, part, w)
            bits = np.unpackbits(index.prints[i] ^ index.fingerprint(part, w)).sum()
            if value >= decontaminate.SIMILARITY - 1e-9 and bits <= decontaminate.RADIUS:
                best[i] = max(best.get(i, 0), value)
    return [(index.items[i][0], pytest.approx(v)) for i, v in sorted(best.items())]


@pytest.mark.parametrize("starts, pairs", [(1 << 14, 1 << 20), (7, 3)])
def test_decontaminate_looks_at_every_window(spark, monkeypatch, starts, pairs):
    monkeypatch.setattr(decontaminate, "STARTS", starts)
    monkeypatch.setattr(decontaminate, "PAIRS", pairs)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items = [*items[:12], (900, "one two three"), (901, "same same same same same same same same")]
    index = decontaminate.Index(items)
    draw = random.Random(8)
    noise = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    made = [None, "", "one two three", "so one two three four", "same " * 40, noise(300)]
    for _, text in items[:12]:
        w = text.split()
        half, third = len(w) // 2, len(w) // 3
        made += [
            noise(30) + " " + " ".join(w[half:] + w[:half]) + " " + noise(30),
            noise(9) + " " + " ".join(w[third:] + w[:third]) + " " + noise(9),
            " ".join(w[: len(w) * 9 // 10]),
            " ".join(w[len(w) // 10 :]) + " " + noise(5) + " " + text,
            " ".join(w[:half]) + " " + noise(len(w) // 20) + " " + " ".join(w[half:]),
        ]
    got = [index.search(t) for t in made]
    assert got == [_every_window(index, t) for t in made]
    swapped = [any(i == items[k][0] for i, _ in got[6 + 5 * k]) for k in range(12)]
    assert sum(swapped) >= 10


def test_near_items_are_all_within_the_radius():
    draw = random.Random(5)
    items = [(k, " ".join(draw.choice("abcdefghij") * draw.randrange(1, 4) for _ in range(30))) for k in range(300)]
    index = decontaminate.Index(items)
    for _ in range(50):
        at = draw.randrange(300)
        bits = np.unpackbits(index.prints[at])
        bits[draw.sample(range(128), draw.randrange(70))] ^= 1
        wanted = [i for i in range(300) if int((np.unpackbits(index.prints[i]) != bits).sum()) <= decontaminate.RADIUS]
        assert index.near(np.packbits(bits)) == wanted


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def _base(t):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(m.start(), 0, m.end(), "email") for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in CARD.finditer(t) if 12 <= len(digits(m)) <= 19 and _luhn(digits(m))]
    out += [(m.start(), 3, m.end(), "phone") for m in PHONE.finditer(t) if 9 <= len(digits(m)) <= 15]
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(out)]


def test_personal_data(spark, texts):
    draw = random.Random(11)
    odd = ["".join(draw.choice("a1@.+-() 49_%é\n\u0001") for _ in range(draw.randrange(5, 120))) for _ in range(400)]
    odd += ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "001.2.3.255 1.2.3.256", "4111 1111 1111 1111", "4111-1111-1111-11111", "+1 (377) 555-0271 x", "+" * 50 + "1" * 30]
    odd += ["1" * 20_000, "a" * 20_000 + "@" + "b." * 9000 + "c", "1.1" * 5000, "call 377-555-0271 now", 'token = "cb1a9fee807a05366fcb8b6c95c7c565ede51a72"']
    every = dict(enumerate(odd)) | {10_000 + k: t for k, t in texts.items()}
    got = {r.doc_id: r for r in pii.report(spark.createDataFrame(list(every.items()), "doc_id long, text string")).collect()}
    for k, t in every.items():
        base = _base(t)
        assert got[k].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), t[:100]
        assert set(base) <= set(got[k].spans.split(",") if got[k].spans else [])
        assert [got[k][f"n_{x}"] for x in pii.BASE] == [sum(b.startswith(x) for b in base) for x in pii.BASE]


def test_long_secrets_and_local_parts_are_found_whole(spark):
    token, local = "aZ09_-" * 70, "first.last_" * 8
    rows = [(1, f"api_key = {token} and more"), (2, f"write to {local} [at] mail [dot] example.org today"), (3, "token=" + "k" * 90_000)]
    whole = {name: re.compile(pattern) for name, _, _, pattern in pii.SOURCES if name in ("secret", "email_spelled")}
    assert whole["secret"].search(rows[0][1]).group().endswith(token)
    assert whole["email_spelled"].search(rows[1][1]).group() == f"{local} [at] mail [dot] example.org"
    masked = {r.doc_id: r.text for r in pii.mask(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # What is masked at all is masked to its end.
    assert masked[1] == rows[0][1] or token[-9:] not in masked[1]
    assert masked[3] == rows[2][1] or "kkk" not in masked[3]


def test_mask(spark):
    rows = [(1, "to und.34@mail7.example.com, from 97.51.17.173.", 5), (2, "nothing", 7), (3, None, 0), (1, "to und.34@mail7.example.com, from 97.51.17.173.", 5)]
    got = pii.mask(spark.createDataFrame(rows, "doc_id long, text string, n_chars long")).collect()
    assert sorted((r.doc_id, r.text or "", r.n_chars) for r in got) == [(1, "to [EMAIL], from [IP].", 22)] * 2 + [(2, "nothing", 7), (3, "", 0)]


def test_em_finds_the_reliable_labelers():
    draw = random.Random(2)
    rows = collections.Counter()
    for _ in range(4000):
        y = draw.random() < 0.4
        vote = lambda p: (1 if y else -1) if draw.random() < p else (-1 if y else 1)
        rows["phone", (vote(0.95), vote(0.9), vote(0.6), 0, vote(0.8)), 1] += 1
    patterns = [(*k, n) for k, n in sorted(rows.items())]
    truth, sure = pii.estimate(patterns)
    assert sure[0, 1, 2] > sure[1, 1, 2] > sure[2, 1, 2]
    beta = pii.fit(patterns, truth)
    assert pii._row("phone", (1, 1, 1, 0, 1), 1) @ beta > 0 > pii._row("phone", (-1, -1, -1, 0, -1), 1) @ beta


def test_pieces_are_the_librarys(spark, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    draw = random.Random(4)
    odd = ["", " ", "   a  b ", "é☃漢字🙂\n\t", "<s> <0x0A> <unk>", "x" * 3000, "\u00a0\u3000", " lead and trail "]
    odd += ["".join(draw.choice("aeinorst lu.,'é") for _ in range(draw.randrange(200))) for _ in range(200)]
    every = dict(enumerate(odd)) | {1000 + k: t for k, t in texts.items()}
    frame = spark.createDataFrame(list(every.items()), "doc_id long, text string")
    coded = pieces.encode(frame, tokenizer_path("piece_bpe_32k.model"))
    back = {r.doc_id: r for r in pieces.decode(coded, tokenizer_path("piece_bpe_32k.model")).collect()}
    for k, t in every.items():
        assert list(back[k].ids) == sp.encode(t), repr(t[:80])
        assert back[k].decoded == t and back[k].round_trip


def test_unigram_paths():
    scores = {"▁": -3.0, "a": -2.0, "b": -2.0, "c": -2.5, "▁a": -2.5, "ab": -2.2, "bc": -1.0, "▁ab": -6.0, "abc": -4.2}
    model = pieces.Pieces(scores, {p: i + 1 for i, p in enumerate(scores)}, [], bpe=False)

    def best(word):
        if not word:
            return 0.0, []
        found = [(scores[word[:k]] + best(word[k:])[0], [word[:k], *best(word[k:])[1]]) for k in range(1, len(word) + 1) if word[:k] in scores]
        return max(found)

    words = ["▁abc", "▁ab", "▁abab", "▁cab", "▁a", "▁bcbc"]
    for word, parts in model.walk(words):
        assert sum(scores[p] for p in parts) == pytest.approx(best(word)[0]) and "".join(parts) == word


def test_quality_and_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality.score(docs, quality.train(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in scored]) > 0.95
    named = language.predict(docs, language.train(docs)).join(docs, "doc_id").filter("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in named]) > 0.98


def test_flattened_trees_fit_a_rule():
    draw = np.random.default_rng(1)
    x = draw.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    model = quality.boost(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.97
    one = model.score(x[2000:2001])
    assert one[0] == model.score(x[2000:])[0]


def test_survivors_of_odd_rows(spark):
    """Equal ids with other texts, null ids, repeated rows, clashing names, no rows."""
    rows = [(1, "a b c d", "x"), (1, "one two three four five", "y"), (2, "a b c d", "x"), (None, "a b c d", "z"), (None, "lone text here now", "z")]
    rows += [(3, "one two three four five", "y")] * 2 + [(4, None, "n"), (5, "", "n"), (None, None, "n")] + [(7, "kept twice over and over", "k")] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    named = frame.withColumnsRenamed({}).selectExpr("*", "fp as h1", "fp as _h1", "fp as component", "fp as first")
    got = simhash_dedup.keep_one(named)
    assert got.columns == named.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(1, "a b c d"), (1, "one two three four five"), (None, "lone text here now"), (4, None), (7, "kept twice over and over")], key=str
    )
    assert simhash_dedup.keep_one(named.limit(0)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels)
    good = {r.doc_id for r in quality.score(docs, model).filter("predicted = 1").collect()}
    kept = docs.filter(docs.doc_id.isin(list(good)))
    # Plain components of plain fingerprints.
    prints = {r.doc_id: _simhash(r.text) for r in kept.collect()}
    heads, left = set(), sorted(prints)
    while left:
        group, left = [left[0]], left[1:]
        heads.add(group[0])
        for a in group:
            near = [b for b in left if (prints[a] ^ prints[b]).bit_count() <= 2]
            group += near
            left = [b for b in left if b not in near]
    unseen = {r.doc_id for r in decontaminate.search(kept, benchmark).filter("not contaminated").collect()} & heads
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(unseen)
    assert all(r.round_trip for r in got)
