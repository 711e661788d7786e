"""Document fingerprints: weighted SimHash in built-in column functions only.

The terms of a text are its runs of three words (the last ones shorter). Each term hashes to
128 bits and votes on every bit with its weight, +w or -w; the fingerprint is the sign of the
sums. Votes are added four bits to a long, in lanes of 16 bits, over chunks of terms too
short to overflow, and the lanes are then unpacked and added up.

Fingerprints within a Hamming radius are found by permuted block tables: the bits are cut
into blocks, and for every choice of blocks that must be untouched there is a table keyed by
those blocks. Documents that share a fingerprint count once in the tables.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlake.llm.common import prepare, settle

WORDS = 3
WEIGHT = 15
CHUNK = 2048
RADIUS = 3
BLOCKS = 4
BUCKET_ROWS = 128
MAX_BUCKETS = 8192
QUERY_STEP = 20

_LANES = 0x0001000100010001


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.lower(text), "\n\r\t\f\v", "     "), " "), lambda w: w != "")


def _terms(words: Column) -> Column:
    """The hashes and weights of a text's terms; a term weighs as much as its first word is long."""
    ahead = lambda i, k: F.get(words, i + k)
    return F.transform(
        words,
        lambda w, i: F.struct(
            F.xxhash64(w, *[ahead(i, k) for k in range(1, WORDS)]).alias("h"),
            F.least(F.length(w), F.lit(WEIGHT)).cast("long").alias("w"),
        ),
    )


def fingerprint(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``hi``, ``lo``: the 128 bits of the fingerprint of each row's text.

    ``keys`` identify a row. A text without words has fingerprint zero.
    """
    # A column of its own: inside the lambda the split would be done again for every word.
    words = rows.select(*keys, _words(F.col(text)).alias("words"))
    terms = words.select(*keys, F.posexplode_outer(_terms(F.col("words"))).alias("at", "term"))
    terms = terms.select(
        *keys, F.floor(F.col("at") / CHUNK).alias("chunk"), F.col("term.h").alias("h1"), F.col("term.w").alias("w")
    ).withColumn("h2", F.xxhash64("h1"))
    lanes = [
        F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_LANES)) * F.col("w")).alias(f"{h}_{i}")
        for h in ("h1", "h2")
        for i in range(16)
    ]
    part = terms.groupBy(*keys, "chunk").agg(F.sum("w").alias("w"), *lanes)
    votes = [
        F.sum(F.shiftrightunsigned(f"{h}_{i}", 16 * k).bitwiseAND(F.lit(0xFFFF))).alias(f"{h}_{i + 16 * k}")
        for h in ("h1", "h2")
        for i in range(16)
        for k in range(4)
    ]
    full = part.groupBy(*keys).agg(F.sum("w").alias("w"), *votes)

    def bits(h: str) -> Column:
        on = [
            F.when(2 * F.col(f"{h}_{i}") > F.col("w"), F.lit(1 << i if i < 63 else -(1 << 63))).otherwise(F.lit(0))
            for i in range(64)
        ]
        return reduce(lambda a, b: a.bitwiseOR(b), on)

    return full.select(*keys, F.coalesce(bits("h1"), F.lit(0)).cast("long").alias("hi"), F.coalesce(bits("h2"), F.lit(0)).cast("long").alias("lo"))


def distance(hi: Column, lo: Column, hi2: Column, lo2: Column) -> Column:
    return F.bit_count(hi.bitwiseXOR(hi2)) + F.bit_count(lo.bitwiseXOR(lo2))


def within_radius(prints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``(hi, lo, hi2, lo2, bits)``: every fingerprint of ``prints`` within ``radius`` of each of ``queries``.

    Both hold columns ``hi`` and ``lo``, without repeats. ``blocks`` is more than ``radius``: with
    ``radius`` changed bits at least ``blocks - radius`` blocks are untouched, so a table for
    each choice of that many finds every pair. More blocks make longer keys and more tables.
    """
    if blocks <= radius or 128 % blocks or blocks < 2:
        raise ValueError("blocks must be more than the radius and divide 128")
    width = 128 // blocks

    def block(b: int) -> Column:
        word, at = ("hi", b * width) if b * width < 64 else ("lo", b * width - 64)
        return F.shiftrightunsigned(word, at).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))

    tables = F.array(
        *[
            F.struct(F.lit(t).alias("table"), F.xxhash64(F.lit(t), *[block(b) for b in chosen]).alias("key"))
            for t, chosen in enumerate(combinations(range(blocks), blocks - radius))
        ]
    )
    left = queries.select("hi", "lo", F.inline(tables))
    right = prints.select("hi", "lo", F.inline(tables)).withColumnsRenamed({"hi": "hi2", "lo": "lo2"})
    bits = distance(F.col("hi"), F.col("lo"), F.col("hi2"), F.col("lo2"))
    pairs = left.join(right, ["table", "key"]).withColumn("bits", bits).filter(F.col("bits") <= radius)
    return pairs.select("hi", "lo", "hi2", "lo2", "bits").distinct()


def _buckets(ids: DataFrame, id_col: str) -> list[float]:
    """Cuts of the ids into buckets of about equal rows; at most ``MAX_BUCKETS``."""
    rows = ids.count()
    many = max(1, min(MAX_BUCKETS, rows // BUCKET_ROWS))
    shares = [k / many for k in range(1, many)]
    cuts = ids.select(F.percentile_approx(id_col, shares, 10 * many)).first()[0] if shares and rows else []
    # One cut at least: the bucketizer asks for it, and any place will do.
    return [float("-inf"), *sorted({float(c) for c in cuts or [0.0]}), float("inf")]


def next_texts(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(bucket, rn, ghost, doc_id, t, next)`` with the text of the next document in descending id.

    After the last document comes the first. Null ids come last; equal ids are ordered by the
    hash of the text. Texts are shuffled once, by ranges of ids; the first document of each
    range is also sent to the range before it, as a ``ghost`` row there.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    cuts = _buckets(base.select("doc_id"), "doc_id")
    # Buckets are numbered downwards, nulls in the last one. Equal ids fall into one bucket.
    place = Bucketizer(splits=cuts, inputCol="_id", outputCol="_b", handleInvalid="keep")
    base = place.transform(base.withColumn("_id", F.col("doc_id").cast("double")))
    base = base.withColumn("bucket", F.when(F.col("doc_id").isNull(), len(cuts)).otherwise(len(cuts) - 2 - F.col("_b")).cast("int"))
    base = base.select("doc_id", "t", "bucket", F.xxhash64("t").alias("h"))
    first = base.groupBy("bucket").agg(F.min(F.struct((-F.col("doc_id")).alias("d"), "h")).alias("f"))
    # One row per bucket, and the number of buckets is bounded: a small window and broadcast.
    before = F.coalesce(F.lag("bucket").over(Window.orderBy("bucket")), F.max("bucket").over(Window.partitionBy(F.lit(0))))
    heads = first.select(F.col("bucket").alias("own"), (-F.col("f.d")).alias("head_id"), F.col("f.h").alias("head_h"), before.alias("before"))
    heads = settle(heads, "fingerprint-heads")
    same = (F.col("bucket") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("h") == F.col("head_h"))
    marked = base.join(F.broadcast(heads), same, "left")
    places = F.when(F.col("own").isNull(), F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("g"))))
    places = places.otherwise(
        F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("g")), F.struct(F.col("before").alias("b"), F.lit(True).alias("g")))
    )
    sent = marked.select("doc_id", "t", "h", F.inline(places).alias("bucket", "ghost"))
    order = Window.partitionBy("bucket").orderBy("ghost", F.col("doc_id").desc_nulls_last(), "h")
    return sent.select("bucket", F.row_number().over(order).alias("rn"), "ghost", "doc_id", "t", F.lead("t").over(order).alias("next"))


def edited_fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Fingerprints of the texts and of their edited forms, one row per row of ``docs``.

    ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``:
    the edited text has its last ``floor(n / 2)`` characters replaced by the first as many of
    the next document. Likeness is 1 less the share of differing bits. A null text is empty.
    """
    prepare(docs.sparkSession)
    rows = next_texts(docs, text, id_col)
    half = F.floor(F.length("t") / 2).cast("int")
    edited = F.concat(F.substring("t", F.lit(1), F.length("t") - half), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half))
    rows = rows.select("bucket", "rn", "ghost", "doc_id", F.length("t").cast("long").alias("n_chars"), "t", F.when(~F.col("ghost"), edited).alias("e"))
    rows = rows.withColumn("sha", F.sha2(F.col("e"), 256))
    forms = F.array(F.struct(F.lit(0).alias("form"), F.col("t").alias("body")), F.struct(F.lit(1).alias("form"), F.col("e").alias("body")))
    keys = ["bucket", "rn", "ghost", "doc_id", "n_chars", "sha"]
    made = fingerprint(rows.select(*keys, F.inline(forms)), [*keys, "form"], "body")
    of = lambda form, c: F.max(F.when(F.col("form") == form, F.col(c)))
    made = made.groupBy(*keys).agg(of(0, "hi").alias("hi"), of(0, "lo").alias("lo"), of(1, "hi").alias("ehi"), of(1, "lo").alias("elo"))
    order = Window.partitionBy("bucket").orderBy("rn")
    made = made.withColumn("nhi", F.lead("hi").over(order)).withColumn("nlo", F.lead("lo").over(order)).filter(~F.col("ghost"))
    text_of = lambda a, b: F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))
    like = lambda a, b: 1 - distance(F.col("hi"), F.col("lo"), F.col(a), F.col(b)) / 128.0
    return made.select(
        "doc_id",
        "n_chars",
        F.col("sha").alias("edited_sha256"),
        text_of("hi", "lo").alias("fingerprint"),
        text_of("ehi", "elo").alias("edited_fingerprint"),
        like("ehi", "elo").alias("near_edited"),
        like("nhi", "nlo").alias("near_next"),
        "hi",
        "lo",
    )


def with_near_counts(made: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Adds ``n_near`` to rows of :func:`edited_fingerprints`: other documents within the radius.

    The query set is every document whose id is divisible by ``QUERY_STEP``, against all rows;
    the others have null.
    """
    made = settle(made, "fingerprints")
    sizes = made.groupBy("hi", "lo").agg(F.count("*").alias("copies"))
    asked = (F.col("doc_id") % QUERY_STEP == 0) & F.col("doc_id").isNotNull()
    found = within_radius(sizes.select("hi", "lo"), made.filter(asked).select("hi", "lo").distinct(), radius)
    found = found.join(sizes.withColumnsRenamed({"hi": "hi2", "lo": "lo2"}), ["hi2", "lo2"])
    found = settle(found.groupBy("hi", "lo").agg(F.sum("copies").alias("n")), "fingerprints-near")
    counted = made.filter(asked).join(found, ["hi", "lo"]).withColumn("n_near", F.col("n") - 1).drop("n")
    rest = made.filter(~F.coalesce(asked, F.lit(False))).withColumn("n_near", F.lit(None).cast("long"))
    return counted.unionByName(rest).drop("hi", "lo")
