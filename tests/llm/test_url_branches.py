"""Branches of the template tree at nodes with many children."""

import pytest

from moodlake.llm import urls


@pytest.mark.parametrize("sections", [15, 25, 60])
def test_blocked_section_among_many(spark, sections):
    rows = [(s * 100 + k, f"http://h.com/sec{chr(97 + s % 26)}{chr(97 + s // 26)}/page-x/{k}") for s in range(sections) for k in range(30)]
    labels = spark.createDataFrame([(i, i < 100) for i, _ in rows if i % 100 < 20], "page_id long, blocked boolean")
    judged = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules=(), labels=labels).collect()
    assert len(judged) == len(rows)
    assert {r.page_id for r in judged if r.verdict == "block"} == {i for i, _ in rows if i < 100}


@pytest.mark.parametrize("sections", [15, 25])
def test_unlabelled_sections_beside_a_ruled_one(spark, sections):
    rows = [(k, f"http://www.example.com/de/{k}") for k in range(30)]
    rows += [(100 * s + k, f"http://www.example.com/sec{chr(96 + s)}/{k}") for s in range(1, sections) for k in range(30)]
    judged = urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert {r.page_id for r in judged if r.verdict == "block"} == set(range(30))


def test_unlabelled_branches_go_with_labelled_ones_that_are_alike(spark):
    """Three sections wholly blocked, one without labels beside them; on another host they differ."""
    rows, marks = [], []
    for host, shares in (("a.test", (1, 1, 1)), ("b.test", (1, 0, 1)), ("c.test", (0, 0, 0)), ("d.test", (1,))):
        for k, section in enumerate("xyzw"):
            for n in range(30):
                rows.append((len(rows), f"https://{host}/{section}/page-{n}a"))
                if k < len(shares):
                    marks.append((rows[-1][0], bool(shares[k])))
    labels = spark.createDataFrame(marks, "page_id long, blocked boolean")
    judged = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules=(), labels=labels).collect()
    got = {(r.host, r.path[1]): r.verdict for r in judged}
    blocked = {(h, s) for (h, s), v in got.items() if v == "block"}
    assert blocked == {("a.test", s) for s in "xyzw"} | {("b.test", "x"), ("b.test", "z"), ("d.test", "x")}


def test_held_out_pages_are_judged_by_the_tree(spark):
    """The rules of the whole table, against the tree that has not seen a fifth of what they decide."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = urls.judge(pages).collect()
    held = [r for r in rows if r.held_out]
    ruled = [r for r in rows if r.rule]
    assert 0.1 * len(ruled) < len(held) < 0.3 * len(ruled)
    assert all(r.verdict == ("allow" if r.rule in ("example.net/en/", "org/fr/") else "block") for r in ruled)
    assert all(r.verdict == r.learned for r in rows if not r.rule)
    # Purity anew from the labels that the tree has seen, and what it learns from them.
    seen = {}
    for r in ruled:
        if not r.held_out:
            seen.setdefault((r.host, r.template), []).append(r.verdict == "block")
    every = [b for bs in seen.values() for b in bs]
    prior = min(sum(every) / len(every), urls.PURITY / 2)
    for r in rows:
        own = seen.get((r.host, r.template), [])
        assert r.purity == pytest.approx((sum(own) + urls.SMOOTHING * prior) / (len(own) + urls.SMOOTHING))
        assert r.learned == ("block" if r.purity >= urls.PURITY else "allow")
    plain = {}
    for r in pages.collect():
        host, path = "", ""
        if r.url and "://" in r.url:
            rest = r.url.split("://", 1)[1]
            end = min(rest.find(c) % (len(rest) + 1) for c in "/?#")
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
            path = rest[end : min(k for k in (rest.find("?", end), rest.find("#", end), len(rest)) if k >= 0)]
        fits = [
            rule for rule in urls.RULES
            if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)
        ]
        plain[r.page_id] = (host, path, max((f.name for f in fits), key=len, default=None))
    assert {r.page_id: (r.host, r.path, r.rule) for r in rows} == plain
