from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leafmill.functions import licences, names, text
from leafmill.functions.pages import even_pages
from leafmill.operators import attempts, matching, ranking
from leafmill.operators.skew import first_delivery, heavy_keys, tree_aggregate
from leafmill.storage import Shelf


def test_tree_aggregate_of_a_heavy_key(spark):
    rows = [(1 if i % 3 else i, None if i % 7 == 0 else i % 11) for i in range(3000)] + [(None, 5)]
    df = spark.createDataFrame(rows, "k long, v int").repartition(40)
    for fan_in in (2, 7, 64):
        out = tree_aggregate(df, ["k"], {"s": ("sum", F.col("v")), "n": ("count", F.col("v")), "lo": ("min", F.col("v")), "hi": ("max", F.col("v"))}, fan_in)
        got = {r["k"]: tuple(r)[1:] for r in out.collect()}
        for k in {r[0] for r in rows}:
            own = [v for x, v in rows if x == k and v is not None]
            assert got[k] == ((sum(own), len(own), min(own), max(own)) if own else (None, 0, None, None))
        assert len(got) == len({r[0] for r in rows})


def test_tree_aggregate_of_nothing_and_of_other_columns(spark):
    df = spark.createDataFrame([], "k long, v int, `__chunk` int, n string")
    assert tree_aggregate(df, ["k"], {"n": ("count", F.lit(1))}).count() == 0
    df = spark.createDataFrame([(1, 2, 9, "x"), (1, 2, 9, "x")], df.schema)
    assert tree_aggregate(df, ["k"], {"n": ("count", F.lit(1))}, chunks=5).collect()[0]["n"] == 2


def test_heavy_keys_at_the_limit(spark):
    df = spark.createDataFrame([(1,)] * 3 + [(i,) for i in range(2, 97)] + [(None,)] * 2, "doc_id long")
    assert [r["doc_id"] for r in heavy_keys(df, "doc_id", 0.03).collect()] == [1]
    assert heavy_keys(df.limit(0), "doc_id", 0.03).count() == 0


def test_first_delivery(spark):
    df = spark.createDataFrame([(1, 1, 7, "b"), (1, 1, 5, "a"), (1, None, 9, None), (1, None, 9, None)], "doc_id long, page_no int, id long, x string")
    got = {(r["page_no"], r["id"], r["x"], r["deliveries"]) for r in first_delivery(df, ["doc_id", "page_no"], ["id"]).collect()}
    assert got == {(1, 5, "a", 2), (None, 9, None, 2)}


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=12), st.integers(0, 200))
def test_split_quota(counts, total):
    quotas = ranking.split_quota(counts, total)
    assert sum(quotas) == min(total, sum(counts)) and all(q <= n for q, n in zip(quotas, counts))


def test_take_quotas_with_a_null_slice(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "ab"[i % 4 // 2]) for i in range(40)], "id long, k string")
    got = ranking.take_quotas(df, "k", {None: 7, "a": 3, "b": 0}, [F.col("id")])
    assert got.columns == ["k", "id"] and sorted(r["id"] for r in got.collect()) == [0, 1, 3, 4, 5, 7, 8, 9, 11, 13]


def test_quota_split_with_documents_of_no_source(spark, tmp_path):
    from leafmill.plans import registry

    df = spark.createDataFrame([(i, "stored", ("A", None, " a", "b")[i % 4]) for i in range(80)], "doc_id long, status string, source string")
    other = {c: F.lit(None).cast("string") for c in ("domain", "url", "discovery_query", "sha256", "discovered_at")}
    df.withColumns(other).write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter(r["source"] for r in registry.queries()["quota_split"](spark, str(tmp_path)).collect())
    assert sum(got.values()) == 40 and got[None] > 0


def test_cap_first_seen_and_turns(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], i % 3) for i in range(12)] + [(99, None, 0), (100, None, 0)], "id long, k string, t int")
    assert max(Counter(r["k"] for r in ranking.cap(df, ["k"], [F.col("id")], 2).collect()).values()) == 2
    seen = {r["id"]: r["n"] for r in ranking.first_seen(df, ["k"], [F.col("id")], "n").collect()}
    assert seen == {0: 5, 1: 5, 99: 0, 100: 0}
    turns = ranking.interleave(df.filter("k is not null"), [["k", "t"], ["k"]], [F.col("id")]).orderBy("turn", "k").collect()
    for n in range(1, len(turns) + 1):
        lanes = Counter(r["k"] for r in turns[:n])
        assert max(lanes.values()) - min(lanes.values() if len(lanes) == 2 else [0]) <= 1


def test_coupled_caps_do_not_use_each_other_up(spark):
    df = spark.createDataFrame([(1, "j", "h1"), (2, "j", "h2"), (3, "k", "h1"), (4, "k", "h2"), (5, None, "h3")], "id long, journal string, host string").withColumn("scope", F.lit(0))
    kept = ranking.coupled_caps(df, {"journal": 1, "host": 1}, ["id"], ["scope"])
    assert sorted(r["id"] for r in kept.collect()) == [1, 4, 5]


def test_capped_turns(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3], "xy"[i % 2]) for i in range(60)], "id long, f string, lang string").withColumn("scope", F.lit(0))
    got = ranking.capped_turns(df, "f", {"f": 5, "lang": 6}, 20, ["id"], ["scope"]).collect()
    assert len(got) == 12 and max(Counter(r["f"] for r in got).values()) <= 5 and max(Counter(r["lang"] for r in got).values()) <= 6


def test_capped_turns_is_that_of_an_uncut_fold(spark):
    def uncut(rows, caps, total):
        lanes, used, chosen = {f: sorted(r for r in rows if r[1] == f) for f in {r[1] for r in rows}}, Counter(), []
        while len(chosen) < total and any(lanes.values()):
            for f in sorted(lanes, key=lambda f: (used["f", f], f)):
                while lanes[f] and len(chosen) < total:
                    i, *own = lanes[f].pop(0)
                    own = list(zip(("f", "dom"), own))
                    if all(used[k] < caps[k[0]] for k in own):
                        used.update(own)
                        chosen.append(i)
                        break
        return sorted(chosen)

    # One domain fills the first 30 rows of each family and holds a third of all; only the last family has rows of others.
    rows = [(100 * k + i, f, "big") for k, f in enumerate("abc") for i in range(30)] + [(1000 + i, "c", None if i % 9 == 0 else f"d{i % 40}") for i in range(180)]
    df = spark.createDataFrame(rows, "id long, f string, dom string").withColumn("scope", F.lit(0))
    for caps, total in (({"f": 6, "dom": 10}, 40), ({"f": 6, "dom": 3}, 40), ({"f": 9, "dom": 2}, 5)):
        got = sorted(r["id"] for r in ranking.capped_turns(df, "f", caps, total, ["id"], ["scope"]).collect())
        assert got == uncut(rows, caps, total)


@pytest.mark.parametrize("n,k,want", [(0, 3, []), (2, 3, [1, 2]), (4, 3, [1, 3, 4]), (10, 3, [2, 6, 10]), (100, 4, [2, 35, 67, 100]), (7, 1, [2])])
def test_even_pages(spark, n, k, want):
    assert spark.range(1).select(even_pages(F.lit(n), k).alias("p")).first()["p"] == want


def test_licence_tiers(spark):
    cases = {None: ("unknown", "unknown"), "": ("unknown", "unknown"), "CC-BY": ("commercial", "commercial"), "CC BY-NC 4.0": ("restricted", "restricted"), "submitted": ("commercial", "unknown"), "MIT License": ("commercial", "commercial"), "All rights reserved.": ("restricted", "restricted"), "CC BY ND 4.0": ("commercial", "restricted"), "GPL": ("unknown", "unknown"), "Public Domain": ("commercial", "commercial")}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", licences.licence_tier(F.col("t")).alias("a"), licences.licence_tier(F.col("t"), True).alias("b"))
    assert {r["t"]: (r["a"], r["b"]) for r in df.collect()} == cases


def test_hosts_and_sources(spark):
    hosts = [("WWW.A.example:80", None, "a.example"), (None, "https://u:p@www.B.example./x", "b.example"), (None, None, None), (None, "no url", None), ("c.example.", "x", "c.example")]
    df = spark.createDataFrame(hosts, "d string, u string, want string")
    assert all(r["got"] == r["want"] for r in df.select("want", names.host(F.col("d"), F.col("u")).alias("got")).collect())
    df = spark.createDataFrame([(" Sec Edgar\t",), ("sec-edgar",), ("SEC_EDGAR",), (None,)], "s string")
    assert [r[0] for r in df.select(names.source_key(F.col("s"))).collect()] == ["sec_edgar"] * 3 + [None]


def test_texts(spark):
    df = spark.createDataFrame([("Name: ____\n[ ] yes  ( ) no\n",), ("",), (None,), ("a b c d e f",), ("word " * 5000,)], "t string")
    rows = df.select(text.words(F.col("t")).alias("w"), text.form_score(F.col("t")).alias("f"), F.size(text.shingles(F.col("t"))).alias("s")).collect()
    assert [r["w"] for r in rows] == [8, 0, 0, 6, 5000] and [r["s"] for r in rows] == [0, 0, 0, 2, 1]
    assert rows[0]["f"] > 0.5 and rows[1]["f"] == 0.0
    one = spark.range(1).select(text.html_text(F.lit("<p>a &amp; b</p> &lt;c&gt;")).alias("h"), text.links(F.lit('<a HREF="x.pdf#p">')).alias("l"), text.last_section(F.lit("a; b  c ;")).alias("s"), text.latest_year(F.lit("r-1998-2004")).alias("y"), text.size_in_bytes(F.lit("3.5 MB")).alias("n"), F.rlike(F.lit("/a/x/b"), text.robots_pattern(F.lit("/a/*/b"))).alias("r")).first()
    assert tuple(one) == ("a & b <c>", ["x.pdf"], "b c", 2004, 3670016, True)


def test_shingle_overlap_is_that_of_brute_force(spark):
    rows = [(i, " ".join(f"w{(i * j) % 37}" for j in range(60))) for i in range(1, 9)] + [(20, None), (21, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    runs = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows if t}
    want = {(a, b) for a in runs for b in runs if min(len(runs[a]), len(runs[b])) >= 20 and len(runs[a] & runs[b]) >= 0.2 * min(len(runs[a]), len(runs[b]))}
    assert {(r["doc_id"], r["item_id"]) for r in matching.shingle_overlap(df, df).collect()} == want


def test_prefixes(spark):
    df = spark.createDataFrame([("a",), ("a/b",), ("a/b/c",), ("ab",), (None,)], "p string")
    assert {(r["p"], r["members"]) for r in matching.containers(df, "p").collect()} == {("a", 2), ("a/b", 1)}
    named = matching.longest_prefix(df, "p", spark.createDataFrame([("a", "short"), ("a/b", "long")], "prefix string, name string"))
    assert {r["p"]: r["name"] for r in named.collect()} == {"a": "short", "a/b": "long", "a/b/c": "long", "ab": "short", None: None}


def test_append_new(spark):
    shelf = Shelf(spark, "test")
    old = attempts.append_new(shelf, "one", None, spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "id long, v string"), ["id"], [F.col("v")])
    new = attempts.append_new(shelf, "two", old, spark.createDataFrame([(2, "q"), (3, "r")], "id long, v string"), ["id"], [F.col("v")])
    assert {tuple(r) for r in old.collect()} == {(1, "x"), (2, "z")} and {tuple(r) for r in new.collect()} == {(3, "r")}
    shelf.drop()


def test_gates_and_plans(spark):
    from leafmill.operators import gates

    df = spark.createDataFrame([(1,), (5,), (None,), (50,)], "v int")
    assert {r["reason"]: r["n"] for r in gates.tally(df, [("large", F.col("v") > 10), ("odd", F.col("v") % 2 == 1)]).collect()} == {"large": 1, "odd": 2, "kept": 1}
    assert [r["v"] for r in df.filter(gates.within(F.col("v"), 2, 10)).collect()] == [5, None]
    plan = [{"source": "a", "name": "x", "kwargs": {"years": "2020", "q": 1}}, {"source": "z", "name": "y", "kwargs": None}]
    assert gates.plan_errors(plan, {"a": {"years"}}) == ["a/x: years must be a list", "a/x: no option q", "z/y: no such source"]


def test_building_a_tree_starts_no_job(spark, data):
    from leafmill.plans import heavy
    from leafmill.storage import table

    def jobs(name, build):
        spark.sparkContext.setJobGroup(name, "")
        build()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    assert jobs("tree", lambda: heavy.p3_page_totals(spark, data)) == jobs("read", lambda: table(spark, data, "pages"))


def test_spread_places_are_those_of_one_window(spark):
    from pyspark.sql import Window

    df = spark.range(3000).select("id", F.when(F.col("id") % 9 < 7, "big").when(F.col("id") % 9 == 7, None).otherwise("x").alias("k"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("o"))
    for x in (df, df.limit(0)):
        want = x.withColumn("place", F.row_number().over(Window.partitionBy("k").orderBy("o", "id")))
        assert sorted(ranking.spread_places(x, ["k"], [F.col("o"), F.col("id")]).collect(), key=str) == sorted(want.collect(), key=str)


def test_scripts_of_samples(spark):
    rows = [("plain text", "latin"), ("", "none"), (None, "none"), ("123 ...", "none"), ("слово и дело", "cy"), ("漢字 text", "cjk"), ("abc " * 9 + "漢", "latin"), ("ひらがな漢", "ja"), ("한국어", "ko"), ("λόγος", "el"), ("हिन्दी", "hi"), ("עברית", "he"), ("ภาษาไทย", "th"), ("العربية", "ar")]
    df = spark.createDataFrame(rows, "t string, want string")
    assert [(r["t"], r["s"]) for r in df.filter(text.script(F.col("t")) != F.col("want")).select("t", text.script(F.col("t")).alias("s")).collect()] == []


def test_languages_on_held_out_documents(spark, data):
    from leafmill.functions.language import Languages
    from leafmill.storage import table

    docs = table(spark, data.replace("sf0.001", "sf0.01"), "documents").filter("lang in ('en', 'fr', 'de', 'es') and length(text) > 100")
    model = Languages.fit(docs.filter("doc_id % 2 = 0").select("text", "lang"))
    rows = docs.filter("doc_id % 2 = 1").select("lang", model.detect(F.col("text")).alias("found")).collect()
    assert sum(r["lang"] == r["found"] for r in rows) >= 0.97 * len(rows)
    odd = spark.createDataFrame([(None,), ("",), ("x",), ("漢字漢字",), ("ภาษาไทย",)], "t string").select(model.detect(F.col("t")).alias("l"))
    assert [r["l"] for r in odd.collect()] == ["und", "und", "und", "zh", "th"]
