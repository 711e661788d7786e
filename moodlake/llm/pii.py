"""Personal data by weak supervision, in built-in column functions only.

Strict and loose patterns propose spans of whole texts. Five labelers vote on each (+1, -1 or
0): the pattern that found it, its checksum or structure, gazetteers, the words before it, and
its edges. Expectation-maximisation over the counts of vote patterns, which are bounded in
number however large the corpus is, estimates how reliable each labeler is and how likely each
pattern is personal data; a logistic span classifier is fitted to those likelihoods and
applied as one column expression. Spans of the strict patterns that pass their checks are
always kept; the classifier adds others.

Positions: a pattern's matches are wrapped in a control character and the text is split at it,
so the pieces alternate between outside and match, and their lengths add up to offsets.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlake.llm.common import prepare, settle

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "iban", "name")
CONTEXT = 48
ACCEPT = 0.5

# (source, kind, cheap test, pattern). The first four are the base patterns; possessive
# repeats and starts at the edge of a run find the same matches in linear time.
SOURCES = (
    ("email", "email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", "ip", r"[0-9]\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", "card", "[0-9][ -]?[0-9]", r"[0-9]++(?:[ -][0-9]++)*+"),
    ("phone", "phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]"),
    (
        "email_spelled", "email", r"(?i)[(\[{]at[)\]}]",
        r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[(\[{]at[)\]}] ?[A-Za-z0-9-]++"
        r"(?:(?: ?[(\[{]dot[)\]}] ?|\.)[A-Za-z0-9-]++){1,8}",
    ),
    ("phone_local", "phone", r"[0-9]{3}[ .-][0-9]{4}", r"(?<![0-9+.)-] ?)(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])"),
    (
        "secret", "secret", "(?i)token|key|secret|passw",
        r"(?i)(?<![a-z])(?:token|api[_-]?key|secret|password|passwd)[\"']? ?[=:] ?[\"']?[A-Za-z0-9_-]{8,}+",
    ),
    ("iban", "iban", "[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    (
        "name", "name", r"(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Madame|Monsieur|Señor|Señora)\b",
        r"(?<!\p{L})(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Madame|Monsieur|Señora|Señor)\.? \p{Lu}[\p{L}'-]{1,40}(?: \p{Lu}[\p{L}'-]{1,40}){0,2}",
    ),
)

TOP_DOMAINS = ("com", "net", "org", "edu", "gov", "info", "io", "eu", "de", "fr", "es", "uk", "it", "nl", "ch", "at", "be")
DIAL_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "49", "52", "55", "61", "81", "86", "91")
FIRST_NAMES = ("anna", "carlos", "claire", "david", "elena", "hans", "jean", "john", "jose", "julia", "karl", "laura", "lukas", "maria", "marie", "michael", "paul", "peter", "pierre", "sarah")
FOR_WORDS = {
    "email": "mail|contact|write|schreib|contacto|courriel",
    "ip": r"\bip\b|server|host|address|adresse|login",
    "card": "card|visa|credit|karte|carte|tarjeta|payment",
    "phone": "phone|call|tel|fax|mobil|anruf|llam|appel",
    "secret": "auth|login|credential",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "name": "dear|signed|author|von|de|from",
}
AGAINST_WORDS = r"version|licen[sc]e|section|chapter|isbn|page|vol\.|article|\bno\.|seite|p[áa]gina"

_MARK, _STAND_IN = "\u0001", "\u0002"
_VOTES = ("v_source", "v_check", "v_list", "v_context", "v_edge")


def _pieces(text: Column, source: str, kind: str, test: str, pattern: str) -> Column:
    parts = F.split(F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}"), _MARK)

    def piece(p: Column, i: Column) -> Column:
        return F.struct(
            F.lit(source).alias("source"),
            F.lit(kind).alias("kind"),
            (i % 2 == 1).alias("hit"),
            F.length(p).alias("n"),
            F.when(i % 2 == 1, p).otherwise(F.right(p, F.lit(CONTEXT))).alias("s"),
            F.left(p, F.lit(1)).alias("f"),
        )

    return F.when(text.rlike(test), F.transform(parts, piece)).otherwise(F.array())


def candidates(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Every proposed span with its votes; a document without any has one row with a null kind.

    ``(rid, doc_id, h, source, kind, start, end, base, votes, size)``; ``rid`` numbers the rows of
    ``docs`` and ``h`` is the hash of the text.
    """
    prepare(docs.sparkSession)
    base = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("raw"),
    ).withColumn("h", F.xxhash64("raw"))
    # The control character that marks the matches is in no pattern; another stands in for it.
    base = base.select("rid", "doc_id", "h", F.translate("raw", _MARK, _STAND_IN).alias("t"))
    # The first piece stands for the document, so that each has a row.
    none = F.lit(None).cast("string")
    first = F.struct(
        none.alias("source"), none.alias("kind"), F.lit(False).alias("hit"), F.lit(0).alias("n"), none.alias("s"), none.alias("f")
    )
    every = F.concat(F.array(first), *[_pieces(F.col("t"), *s) for s in SOURCES])
    rows = base.select("rid", "doc_id", "h", F.posexplode(every).alias("at", "p")).select("rid", "doc_id", "h", "at", "p.*")
    rows = settle(rows, "pii-pieces")
    order = Window.partitionBy("rid", "source").orderBy("at")
    rows = rows.withColumn("end", F.sum("n").over(order)).withColumn("before", F.lag("s").over(order)).withColumn("after", F.lead("f").over(order))
    rows = rows.filter("hit or kind is null").withColumn("start", F.col("end") - F.col("n"))
    return settle(_vote(rows), "pii-candidates")


def _vote(rows: DataFrame) -> DataFrame:
    s, kind = F.col("s"), F.col("kind")
    digits = F.regexp_replace(s, "[^0-9]", "")
    count = F.length(digits)
    octet = lambda k: F.regexp_replace(F.get(F.split(s, r"\."), k - 1), "^0+(?=[0-9])", "")
    small = lambda o: (F.length(o) <= 3) & (F.lpad(o, 3, "0") <= "255")
    octets = reduce(lambda a, b: a & b, [small(octet(k)) for k in range(1, 5)])
    luhn = F.when(count.between(12, 19), F.call_function("luhn_check", digits)).otherwise(False)
    valid = (
        F.when(F.col("source") == "email", True)
        .when(F.col("source") == "ip", octets)
        .when(F.col("source") == "card", luhn)
        .when(F.col("source") == "phone", count.between(9, 15))
        .otherwise(False)
    )
    domain = F.lower(F.regexp_extract(s, r"([A-Za-z0-9-]+)$", 1))
    yes_no = lambda c: F.when(c, 1).otherwise(-1)
    check = (
        F.when(kind == "email", yes_no(domain.rlike("^[a-z]{2,24}$")))
        .when(kind == "ip", yes_no(octets))
        .when(kind == "card", yes_no(luhn))
        .when(kind == "phone", yes_no(count.between(9, 15)))
        .when(kind == "secret", yes_no((count >= 4) & (F.length(s) >= 24)))
        .otherwise(0)
    )
    listed = (
        F.when(kind == "email", F.when(domain.isin(*TOP_DOMAINS), 1).otherwise(0))
        .when(kind == "ip", F.when(F.regexp_extract(s, "^[0-9]+", 0).isin("0", "127", "255"), -1).otherwise(0))
        .when(kind == "card", F.when(digits.rlike("^[2-6]") & count.between(12, 19), 1).otherwise(-1))
        .when(kind == "phone", F.when(digits.rlike(f"^(?:{'|'.join(DIAL_CODES)})") & s.startswith("+"), 1).otherwise(0))
        .when(kind == "name", F.when(F.lower(s).rlike(rf"\b(?:{'|'.join(FIRST_NAMES)})\b"), 1).otherwise(0))
        .otherwise(0)
    )
    before = F.lower(F.coalesce("before", F.lit("")))
    words = reduce(lambda c, k: c.when(kind == k, before.rlike(FOR_WORDS[k])), KINDS[1:], F.when(kind == KINDS[0], before.rlike(FOR_WORDS[KINDS[0]])))
    context = F.when(before.rlike(AGAINST_WORDS), -1).when(words, 1).otherwise(0)
    joined = before.rlike(r"[\p{L}\p{N}_]$") | F.coalesce("after", F.lit("")).rlike(r"[\p{L}\p{N}_]")
    size = F.when(F.col("n") <= 8, 0).when(F.col("n") <= 16, 1).when(F.col("n") <= 32, 2).otherwise(3)
    out = rows.select(
        "rid", "doc_id", "h", "source", "kind", "start", "end",
        (F.col("source").isin(*BASE) & valid).alias("base"),
        F.when(valid, 1).when(F.col("source").isin(*BASE), -1).otherwise(0).alias("v_source"),
        check.alias("v_check"), listed.alias("v_list"), context.alias("v_context"), yes_no(~joined).alias("v_edge"),
        size.alias("size"),
    )
    return _drop_short(out)


def _drop_short(rows: DataFrame) -> DataFrame:
    """Numbers of fewer than 12 characters are no proposals; their document keeps a row."""
    short = (F.col("source") == "card") & ~F.col("base") & (F.col("end") - F.col("start") < 12)
    keep = ["rid", "doc_id", "h"]
    return rows.select(*keep, *[F.when(short, None).otherwise(F.col(c)).alias(c) for c in rows.columns if c not in keep])


def estimate(patterns: list[tuple[str, tuple[int, ...], int, int]], rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """EM over ``(kind, votes, size, count)``: likelihood of each pattern, reliability of each labeler.

    Labelers are taken as independent given the truth. Reliability is P(vote | truth), shape
    (labelers, 2, 3), votes in the order -1, 0, +1.
    """
    votes = np.array([p[1] for p in patterns]).reshape(len(patterns), -1) + 1
    weight = np.array([p[3] for p in patterns], float)
    kinds = np.array([KINDS.index(p[0]) for p in patterns])
    truth = 1 / (1 + np.exp(-1.5 * (votes - 1).sum(1)))
    sure = np.zeros((votes.shape[1], 2, 3))
    for _ in range(rounds):
        prior = np.full(len(KINDS), 0.5)
        for k in range(len(KINDS)):
            w = weight[kinds == k]
            prior[k] = ((w * truth[kinds == k]).sum() + 1) / (w.sum() + 2)
        log = np.stack([np.log(1 - prior[kinds]), np.log(prior[kinds])], 1)
        for j in range(votes.shape[1]):
            for y, share in enumerate((1 - truth, truth)):
                # A labeler is right more often than not: the prior counts lean that way.
                lean = np.array([1.0, 1.0, 3.0]) if y else np.array([3.0, 1.0, 1.0])
                counts = np.bincount(votes[:, j], weight * share, 3) + lean
                sure[j, y] = counts / counts.sum()
            log += np.log(sure[j][:, votes[:, j]].T)
        truth = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
    return truth, sure


def _row(kind: str, votes: tuple[int, ...], size: int) -> list[float]:
    return [1.0, *(float(kind == k) for k in KINDS), *(float(v == s) for v in votes for s in (1, -1)), *(float(size == b) for b in range(4))]


def fit(patterns: list[tuple[str, tuple[int, ...], int, int]], truth: np.ndarray, steps: int = 400) -> np.ndarray:
    """Weights of the logistic span classifier for the likelihoods of the patterns."""
    x = np.array([_row(*p[:3]) for p in patterns])
    # The logarithm keeps frequent patterns from drowning the others.
    w = np.log1p(np.array([p[3] for p in patterns], float))
    w /= w.sum()
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ beta))
        beta += 4.0 * (x.T @ (w * (truth - p)) - 1e-4 * beta)
    return beta


def classify(found: DataFrame) -> DataFrame:
    """Adds ``likely``: whether the span classifier, trained on all proposals, takes the span."""
    rows = found.filter("kind is not null").groupBy("kind", *_VOTES, "size").agg(F.count("*").alias("n")).collect()
    patterns = sorted((r.kind, tuple(r[v] for v in _VOTES), r["size"], r.n) for r in rows)
    if not patterns:
        return found.withColumn("likely", F.lit(False))
    truth, _ = estimate(patterns)
    beta = iter(fit(patterns, truth).tolist())
    terms = [F.lit(next(beta))]
    terms += [F.when(F.col("kind") == k, next(beta)).otherwise(0.0) for k in KINDS]
    terms += [F.when(F.col(v) == s, next(beta)).otherwise(0.0) for v in _VOTES for s in (1, -1)]
    terms += [F.when(F.col("size") == b, next(beta)).otherwise(0.0) for b in range(4)]
    return found.withColumn("likely", reduce(lambda a, b: a + b, terms) > math.log(ACCEPT / (1 - ACCEPT)))


def spans(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The spans kept, one row each, and one row with a null kind for documents without any.

    ``(rid, doc_id, h, kind, start, end, base)``, places in code points, ends exclusive. An added
    span that overlaps a base span, or an added one before it, is left out.
    """
    found = classify(candidates(docs, text, id_col))
    keep = F.col("base") | F.coalesce(F.col("likely"), F.lit(False))
    clear = [F.when(keep, F.col(c)).alias(c) for c in ("kind", "start", "end", "base")]
    rows = found.select("rid", "doc_id", "h", *clear)
    here = Window.partitionBy("rid").orderBy(F.col("start").asc_nulls_last(), F.col("end").desc(), "kind")
    past = F.max(F.when(F.col("base"), F.col("end"))).over(here.rowsBetween(Window.unboundedPreceding, -1))
    coming = F.min(F.when(F.col("base"), F.col("start"))).over(here.rowsBetween(1, Window.unboundedFollowing))
    added = F.max("end").over(here.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("past", F.greatest(past, added)).withColumn("coming", coming)
    clash = ~F.col("base") & ((F.coalesce("past", F.lit(-1)) > F.col("start")) | (F.coalesce("coming", F.col("end")) < F.col("end")))
    clash = F.coalesce(clash, F.lit(False))
    return rows.select("rid", "doc_id", "h", *[F.when(~clash, F.col(c)).alias(c) for c in ("kind", "start", "end", "base")])


def _listing(chosen: Column) -> Column:
    """``kind:start:end`` by start, then kind in the listed order, joined by commas."""
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    one = F.when(chosen, F.struct(F.col("start"), rank.alias("r"), F.col("end"), F.col("kind")))
    return F.array_join(F.transform(F.sort_array(F.collect_list(one)), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)``, one row per row of ``docs``.

    The counts and the digest are those of the base spans; ``spans`` lists all. A null text is
    empty and a null id stays.
    """
    found = spans(docs, text, id_col)
    counts = [F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in BASE]
    out = found.groupBy("rid", "doc_id").agg(
        *counts, F.sha2(_listing(F.col("base")), 256).alias("base_sha256"), _listing(F.col("kind").isNotNull()).alias("spans")
    )
    return out.drop("rid")


def mask(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs``, all rows and columns, with every span replaced by its kind in brackets.

    Where there is a column ``n_chars``, it is set to the new length of a changed text.
    """
    found = spans(docs, text, id_col).filter("kind is not null")
    one = F.struct("start", "end", "kind")
    # Names that no column of the caller's has.
    tag = "_" * (1 + max(map(len, docs.columns)))
    own, hashed, cuts_of = (tag + x for x in ("id", "h", "cuts"))
    cuts = found.groupBy(F.col("doc_id").alias(own), F.col("h").alias(hashed)).agg(F.sort_array(F.collect_set(one)).alias(cuts_of))
    cuts = settle(cuts, "pii-cuts")
    same = F.col(id_col).eqNullSafe(F.col(own)) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col(hashed))
    # A text that passes no cheap test has no span: it is not moved to meet the spans.
    could = F.coalesce(reduce(lambda a, b: a | b, [F.col(text).rlike(test) for _, _, test, _ in SOURCES]), F.lit(False))
    joined = docs.filter(could).join(cuts, same, "left")
    t = F.col(text)
    # Each span with the text between it and the span before it; of two that overlap, as base
    # spans of different kinds may, the second is joined to the first.
    last = lambda i: F.array_max(F.transform(F.slice(cuts_of, F.lit(1), i), lambda c: c["end"]))
    start_of = lambda c, i: F.when(i == 0, F.lit(0)).otherwise(last(i))
    between = F.transform(
        cuts_of,
        lambda c, i: F.when(
            c["start"] >= start_of(c, i),
            F.concat(F.substring(t, (start_of(c, i) + 1).cast("int"), (c["start"] - start_of(c, i)).cast("int")), F.lit("["), F.upper(c["kind"]), F.lit("]")),
        ).otherwise(F.lit("")),
    )
    tail = F.substring(t, (last(F.size(cuts_of)) + 1).cast("int"), F.length(t))
    changed = F.when(F.col(cuts_of).isNull(), t).otherwise(F.concat(F.array_join(between, ""), tail))
    out = joined.withColumn(text, changed)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(cuts_of).isNull(), F.col("n_chars")).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType))
    return docs.filter(~could).unionByName(out.select(*docs.columns))
