"""Choices among documents and pages: first seen, caps, turns, quotas, strides; states of attempts; joins by prefix and likeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.functions import dates, text
from leafmill.functions.language import Languages
from leafmill.functions.names import host, source_key
from leafmill.functions.pages import even_pages
from leafmill.operators import attempts, matching, ranking
from leafmill.plans.catalogue import KEY
from leafmill.storage import table

QUERIES: dict = {}
SQL: dict[str, str] = {}

SHA = "nullif(regexp_extract(lower(sha256), '[0-9a-f]{64}'), '')"
HOST = r"nullif(regexp_replace(regexp_replace(lower(trim(coalesce(domain, regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)))), ':[0-9]*$', ''), '^www\.|\.+$', '', 'g'), '')"


def query(sql: str | None = None):
    def note(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return note


def _docs(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select("doc_id", source_key(F.col("source")).alias("source"), host(F.col("domain"), F.col("url")).alias("domain"), "discovery_query", "status", F.nullif(F.regexp_extract(F.lower("sha256"), "[0-9a-f]{64}", 0), F.lit("")).alias("sha"), "discovered_at")


@query(f"select sha, min(doc_id) as doc_id from (select {SHA} as sha, doc_id from documents) where sha is not null group by sha")
def sha_first_document(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).filter("sha is not null").groupBy("sha").agg(F.min("doc_id").alias("doc_id"))


@query(f"select doc_id, dupes from (select doc_id, case when sha is null then 0 else count(*) over (partition by sha) - 1 end as dupes, case when sha is null then 1 else row_number() over (partition by sha order by doc_id) end as k from (select doc_id, {SHA} as sha from documents where status = 'stored')) where k = 1")
def dupe_docs(spark: SparkSession, d: str) -> DataFrame:
    """The first stored document of each content hash, with the number of its copies."""
    docs = _docs(spark, d).filter("status = 'stored'").select("doc_id", "sha")
    return ranking.first_seen(docs, ["sha"], [F.col("doc_id")], "dupes").select("doc_id", "dupes")


@query(f"with h as (select doc_id, discovered_at, {HOST} as h from documents) select doc_id from (select doc_id, row_number() over (partition by h order by discovered_at, doc_id) as k from h) where k <= 5")
def cap_per_domain(spark: SparkSession, d: str) -> DataFrame:
    return ranking.cap(_docs(spark, d).select("doc_id", "domain", "discovered_at"), ["domain"], [F.asc_nulls_last("discovered_at"), F.col("doc_id")], 5).select("doc_id")


@query(f"select doc_id, source, row_number() over (partition by source order by discovered_at, doc_id) as turn from (select doc_id, {KEY} as source, discovered_at from documents)")
def round_robin_interleave(spark: SparkSession, d: str) -> DataFrame:
    """All documents, in turns between sources."""
    rows = _docs(spark, d).select("doc_id", "source", "discovered_at")
    return ranking.interleave(rows, [["source"]], [F.asc_nulls_last("discovered_at"), F.col("doc_id")]).select("doc_id", "source", "turn")


@query(f"""with a as (select doc_id, {KEY} as source, discovery_query as name, row_number() over (partition by {KEY}, discovery_query order by doc_id) as t from documents where discovery_query is not null)
    select doc_id, row_number() over (partition by source order by t, source, name, doc_id) as turn from a""")
def two_level_interleave(spark: SparkSession, d: str) -> DataFrame:
    """The queries of a source take turns, then the sources do."""
    rows = _docs(spark, d).filter("discovery_query is not null").select("doc_id", "source", "discovery_query")
    return ranking.interleave(rows, [["source", "discovery_query"], ["source"]], [F.col("doc_id")]).select("doc_id", "turn")


@query("select doc_id, page_no from (select distinct doc_id, page_no from pages) where page_no >= 3 and (page_no - 3) % 7 = 0")
def stride_sample(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("doc_id", "page_no").distinct().filter("page_no >= 3 and (page_no - 3) % 7 = 0")


@query("""with k as (select doc_id, n_pages as n, case when n_pages > 4 then 2 else 1 end as s from pdf_documents where n_pages > 0)
    select distinct doc_id, page_no::int as page_no from (select doc_id, unnest(case when n <= 8 then range(1, n + 1) else list_transform(range(0, 8), lambda i: s + round_even(i * (n - s)::double / 7, 0)::bigint) end) as page_no from k)""")
def even_page_sample(spark: SparkSession, d: str) -> DataFrame:
    """At most eight pages of each document, evenly spread."""
    return table(spark, d, "pdf_documents").select("doc_id", F.explode(even_pages(F.col("n_pages"), 8)).alias("page_no"))


@query(f"select doc_id, place from (select doc_id, row_number() over (partition by source order by sha256('17|' || doc_id::varchar)) as place from (select doc_id, {KEY} as source from documents where status = 'stored')) where place <= 20")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    """Twenty stored documents of each source in a repeatable random order."""
    rows = _docs(spark, d).filter("status = 'stored'").withColumn("order", ranking.seeded("doc_id", seed=17))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("source").orderBy("order"))).filter("place <= 20").select("doc_id", "place")


@query(f"""with recursive d as (select doc_id, {KEY} as source from documents where status = 'stored'),
    c as (select source, count(*) as n, row_number() over (order by source nulls first) as i from d group by source), k as (select count(*) as k, sum(n) // 2 as total from c),
    a(i, source, n, quota, rest) as (
        select i, source, n, least(n, ceil(total::double / k)::bigint), total - least(n, ceil(total::double / k)::bigint) from c, k where i = 1
        union all select c.i, c.source, c.n, least(c.n, ceil(greatest(rest, 0)::double / (k - a.i))::bigint), rest - least(c.n, ceil(greatest(rest, 0)::double / (k - a.i))::bigint) from a join c on c.i = a.i + 1, k),
    b as (select *, coalesce(sum(n - quota) over (order by i rows between unbounded preceding and 1 preceding), 0) as before, (select rest from a order by i desc limit 1) as rest_all from a),
    q as (select source, quota + least(n - quota, greatest(rest_all - before, 0)) as quota from b)
    select r.source, doc_id from (select *, row_number() over (partition by source order by doc_id) as p from d) r join q on q.source is not distinct from r.source where p <= quota""")
def quota_split(spark: SparkSession, d: str) -> DataFrame:
    """Half of the stored documents, split evenly over sources as far as they have any; those without source are one source."""
    rows = _docs(spark, d).filter("status = 'stored'").select("doc_id", "source")
    counts = rows.groupBy("source").count().orderBy("source").limit(10_001).collect()
    if len(counts) > 10_000:
        raise ValueError("more than 10,000 sources")
    quotas = ranking.split_quota([r["count"] for r in counts], sum(r["count"] for r in counts) // 2)
    return ranking.take_quotas(rows, "source", dict(zip([r["source"] for r in counts], quotas)), [F.col("doc_id")])


@query()
def coupled_caps(spark: SparkSession, d: str) -> DataFrame:
    """At most 3 documents of a query and 5 of a domain within each batch of a day and source."""
    rows = _docs(spark, d).select("doc_id", "source", "domain", "discovery_query", F.to_date("discovered_at").alias("day"))
    return ranking.coupled_caps(rows, {"discovery_query": 3, "domain": 5}, ["doc_id"], ["day", "source"]).select("doc_id")


@query()
def capped_turns(spark: SparkSession, d: str) -> DataFrame:
    """Per day up to 40 documents, sources taking turns, at most 6 of a source and 10 of a domain."""
    rows = _docs(spark, d).filter("source is not null").select("doc_id", "source", F.coalesce("domain", F.lit("")).alias("domain"), F.to_date("discovered_at").alias("day"))
    return ranking.capped_turns(rows, "source", {"source": 6, "domain": 10}, 40, ["doc_id"], ["day"]).select("doc_id", "day")


@query("""with a as (select distinct id, doc_id, ts, ok, error from fetch_attempts), g as (select doc_id, count(*) filter (ok) as good, count(*) filter (not coalesce(ok, false)) as bad from a group by doc_id)
    select doc_id, good, bad, case when good > 0 then 'done' when bad >= 3 then 'failed' else 'open' end as state from g""")
def terminal_after_three(spark: SparkSession, d: str) -> DataFrame:
    return attempts.outcome(table(spark, d, "fetch_attempts")).select("doc_id", "good", "bad", "state")


@query("select doc_id, coalesce(fetched_at, discovered_at) as since from documents where status = 'fetching' and coalesce(fetched_at, discovered_at) < timestamptz '2025-05-02 00:00:00+00' - interval 3600 second")
def stale_reclaim(spark: SparkSession, d: str) -> DataFrame:
    return attempts.stale(table(spark, d, "documents"), "2025-05-02 00:00:00+00:00")


@query(f"""with a as (select {KEY} as source, f.id, f.ts, coalesce(ok, false) as good from (select distinct * from fetch_attempts) f join documents using (doc_id)),
    r as (select *, row_number() over (partition by source order by ts, id) - row_number() over (partition by source, good order by ts, id) as run from a),
    e as (select source, good, run, count(*) as n from r group by 1, 2, 3)
    select source, coalesce(max(n) filter (not good), 0) as longest, sum(case when good then 0 else n end)::bigint as failed, sum(n)::bigint as attempts from e group by source""")
def failure_streaks(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "fetch_attempts").distinct().join(table(spark, d, "documents").select("doc_id", source_key(F.col("source")).alias("source")), "doc_id")
    return attempts.failure_streaks(log.select("source", "id", "ts", "ok"), "source")


@query("select strftime(ts::timestamp, '%Y-%m-%d') as day, event_type, count(*) as n from events group by 1, 2")
def events_by_day(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.date_format(F.window(F.col("ts").cast("timestamp"), "1 day").start, "yyyy-MM-dd").alias("day"), "event_type").agg(F.count("*").alias("n"))


@query("""with e as (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) < interval 30 minute then 0 else 1 end as new from events),
    s as (select *, sum(new) over (partition by user_id order by ts, event_id) as session from e) select user_id, count(*) as n, count(*) filter (event_type = 'error') as errors, min(ts) as first_ts from s group by user_id, session""")
def event_sessions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp"))
    return e.groupBy("user_id", F.session_window("at", "30 minutes")).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"), F.min("ts").alias("first_ts")).drop("session_window")


@query("select event_id, (props->>'k')::bigint as k from events where (props->>'k') is not null")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k")).filter("k is not null")


@query("select doc_id, (extra->>'batch')::bigint as batch, coalesce(nullif(left(trim(extra->>'title'), 160), ''), source_id) as title from documents")
def titles(spark: SparkSession, d: str) -> DataFrame:
    """The title in extra, at most 160 characters, else the id in the source."""
    title = F.nullif(F.substring(F.trim(F.get_json_object("extra", "$.title")), 1, 160), F.lit(""))
    return table(spark, d, "documents").select("doc_id", F.get_json_object("extra", "$.batch").cast("long").alias("batch"), F.coalesce(title, "source_id").alias("title"))


@query(f"select doc_id, {HOST} as domain from documents")
def domain_of_url(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", host(F.col("domain"), F.col("url")).alias("domain"))


@query(r"""select doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '')) as words from documents""")
def word_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.words(F.col("text")).alias("words"))


@query(r"""with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line from documents) select doc_id, count(*) as lines, count(*) filter (regexp_matches(trim(line), '^[ \t\n\x0B\f\r(\[]*[-+$€£¥]?[ \t\n\x0B\f\r]*[0-9][0-9,. \t\n\x0B\f\r]*[ \t\n\x0B\f\r]*[%)\]a-zA-Z]{0,3}[ \t\n\x0B\f\r]*$')) as numeric from l where trim(line) <> '' group by doc_id""")
def numeric_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.explode(text.filled_lines(F.col("text"))).alias("line"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(text.is_numeric(F.col("line"))).alias("numeric"))


_RANGES = {"ar": (0x600, 0x6FF), "cjk": (0x4E00, 0x9FFF), "ja": (0x3040, 0x30FF), "ko": (0xAC00, 0xD7AF), "el": (0x370, 0x3FF), "cy": (0x400, 0x4FF), "hi": (0x900, 0x97F), "he": (0x590, 0x5FF), "th": (0xE00, 0xE7F)}
_SCRIPT = "case when l = '' then 'none' " + " ".join(f"when len(regexp_extract_all(l, '[\\x{{{a:04X}}}-\\x{{{b:04X}}}]')) > 0.3 * length(l) then '{k}'" for k, (a, b) in _RANGES.items()) + " else 'latin' end"


@query(rf"with l as (select doc_id, regexp_replace(coalesce(text, ''), '[^\pL]+', '', 'g') as l from documents) select doc_id, {_SCRIPT} as script from l")
def scripts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.script(F.col("text")).alias("script"))


@query()
def languages(spark: SparkSession, d: str) -> DataFrame:
    """The language of every text, by a model fitted to a bounded number of documents whose language is known."""
    docs = table(spark, d, "documents")
    code = F.lower(F.trim("lang"))
    known = docs.select("text", F.when(code.isin("en", "eng"), "en").when(code.isin("fr", "fra", "fre"), "fr").when(code.isin("de", "deu", "ger"), "de").when(code.isin("es", "spa"), "es").alias("lang"))
    return docs.select("doc_id", Languages.fit(known).detect(F.col("text")).alias("lang"))


_WORDS = r"len(list_filter(regexp_split_to_array(x, '[ \t\n\x0B\f\r]+'), lambda w: w <> ''))"


@query(rf"""with t as (select doc_id, coalesce(text, '') as t, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x) <> '') as l from documents),
    s as (select doc_id, len(l) as n, len(regexp_extract_all(t, '_{{3,}}|\.{{6,}}|…{{2,}}')) as fills, len(regexp_extract_all(t, '[☐☑☒□■▢◻◼○●]|\[[ \t\n\x0B\f\r]?\]|\([ \t\n\x0B\f\r]?\)')) as boxes,
        len(list_distinct(list_transform(regexp_extract_all(t, '(?i)\b(?:signature|date signed|print name|name of|address|city|state|zip|telephone|phone|ssn|social security|ein|employer identification|omb no|form [a-z]?-?\d|part [ivx]+\b|section [a-z\d]\b|check (?:one|all|the box|if)|yes\s+no|for office use|applicant|signature of|title|amount|total)\b'), lambda x: lower(x)))) as phrases,
        len(list_filter(l, lambda x: regexp_matches(x, '^[ \t\n\x0B\f\r]*[A-Z][A-Za-z /&().''-]{{1,40}}:[ \t\n\x0B\f\r]*$'))) as labels,
        coalesce(list_sum(list_transform(l, lambda x: case when {_WORDS} <= 4 then 0.8::double when {_WORDS} >= 14 then -1.2::double else 0::double end)), 0) as lines from t)
    select doc_id, case when n = 0 then 0 else round(least(fills, 20) * 0.08::double + least(boxes, 20) * 0.06::double + least(phrases, 15) * 0.09::double + least(labels, 20) * 0.04::double + lines / n, 3) end as score from s""")
def form_score(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.round(text.form_score(F.col("text")), 3).alias("score"))


@query(r"""with t as (select doc_id, source, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') as w from documents where status = 'stored'),
    s as (select doc_id, source, list_distinct(list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i:i + 4], ' '))) as s from t where len(w) >= 5),
    e as (select doc_id, len(s) as n, unnest(s) as run from s where len(s) >= 20), b as (select doc_id as item_id, len(s) as m, unnest(s) as run from s where len(s) >= 20 and lower(trim(source)) = 'hkex'),
    p as (select doc_id, item_id, n, m, count(*) as shared from e join b using (run) group by all)
    select doc_id, item_id, shared from p where shared >= 0.2 * least(n, m)""")
def shingle_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Stored documents near to one of the source hkex, which stands for a benchmark to keep out."""
    docs = table(spark, d, "documents").filter("status = 'stored'").select("doc_id", "text", "source")
    return matching.shingle_overlap(docs.select("doc_id", "text"), docs.filter("lower(trim(source)) = 'hkex'").select("doc_id", "text"))


@query("""with p as (select distinct regexp_extract(stored_path, '^(.*)/[^/]*$', 1) as dir from documents where stored_path is not null), a as (select dir from p union select regexp_extract(dir, '^(.*)/[^/]*$', 1) from p)
    select a.dir as path, (select count(*) from a b where starts_with(b.dir, a.dir || '/')) as members from a where (select count(*) from a b where starts_with(b.dir, a.dir || '/')) > 0""")
def prefix_containers(spark: SparkSession, d: str) -> DataFrame:
    """Folders of the store that hold other folders."""
    up = lambda c: F.regexp_extract(c, "^(.*)/[^/]*$", 1)
    dirs = table(spark, d, "documents").filter("stored_path is not null").select(up(F.col("stored_path")).alias("path")).distinct()
    return matching.containers(dirs.union(dirs.select(up(F.col("path")))).distinct(), "path")


@query("""with s as (select distinct name from slices), u as (select doc_id, regexp_extract(url, '^[a-zA-Z]+://[^/]*/(.*)$', 1) as path from documents)
    select doc_id, (select name from s where starts_with(path, name) order by length(name) desc, name limit 1) as name from u""")
def longest_prefix(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "slices").select(F.col("name").alias("prefix"), "name").distinct()
    docs = table(spark, d, "documents").select("doc_id", F.regexp_extract("url", "^[a-zA-Z]+://[^/]*/(.*)$", 1).alias("path"))
    return matching.longest_prefix(docs, "path", names).select("doc_id", "name")


@query("select doc_id from (select doc_id from documents where status = 'stored' except select doc_id from subject_labels)")
def used_difference(spark: SparkSession, d: str) -> DataFrame:
    """Stored documents that aren't in use (labelled) yet; an anti-join, so nulls in the other table don't matter."""
    return table(spark, d, "documents").filter("status = 'stored'").select("doc_id").join(table(spark, d, "subject_labels").select("doc_id"), "doc_id", "left_anti")


@query("select s.source, y::int as year, v as version from (select distinct lower(trim(source)) as source from mix_targets) s, range(2001, 2011) t(y), (values ('a'), ('b'), ('c')) x(v)")
def generated_keys(spark: SparkSession, d: str) -> DataFrame:
    """A cross product of three small sets, made by nested generators."""
    x = table(spark, d, "mix_targets").select(F.lower(F.trim("source")).alias("source")).distinct()
    return x.withColumn("year", F.explode(F.sequence(F.lit(2001), F.lit(2010)))).withColumn("version", F.explode(F.array(*map(F.lit, "abc"))))


@query("select greatest(make_date(y::int, 1, 1), date '1991-04-01') as start, least(make_date(y::int, 12, 31), date '2025-06-30') as end from range(1991, 2026) t(y)")
def year_windows(spark: SparkSession, d: str) -> DataFrame:
    return dates.year_windows(spark, "1991-04-01", "2025-06-30")


@query("select m::date as start, (m + interval 1 month)::date as end from range(date '2023-02-01', date '2025-05-02', interval 1 month) t(m)")
def month_windows(spark: SparkSession, d: str) -> DataFrame:
    return dates.month_windows(spark, "2023-02-14", "2025-05-01")


@query("select day::date as day from range(date '2025-02-01', date '2025-05-02', interval 1 day) t(day)")
def day_walk(spark: SparkSession, d: str) -> DataFrame:
    return dates.days(spark, "2025-02-01", "2025-05-01")


@query("select y::int as year, q::int as quarter, make_date(y::int, (3 * q - 2)::int, 1) as start from range(2019, 2026) t(y), range(1, 5) u(q) where make_date(y::int, (3 * q - 2)::int, 1) <= date '2025-05-01'")
def quarters_begun(spark: SparkSession, d: str) -> DataFrame:
    return dates.quarters_begun(spark, 2019, "2025-05-01")


@query("""with recursive c as (select discovered_at::date as day, count(*) as n from documents where discovered_at is not null group by 1), most as (select greatest(sum(n) // 10, 1) as most from c),
    w(low, high, n) as (select min(day), max(day), sum(n)::bigint from c
        union all select h.low, h.high, (select coalesce(sum(c.n), 0)::bigint from c where c.day between h.low and h.high) from
            (select unnest([low, low + ((high - low) // 2 + 1)::int]) as low, unnest([low + ((high - low) // 2)::int, high]) as high from w, most where n > most and low < high) h)
    select low, high, n from w, most where n <= most or low = high""")
def bisected_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windows of discovery days that hold at most a tenth of the documents each."""
    docs = table(spark, d, "documents").filter("discovered_at is not null")
    counts = docs.groupBy(F.to_date("discovered_at").alias("day")).agg(F.count("*").alias("n"))
    return dates.bisected(counts, 0.1)


@query("""select l_returnflag, l_linestatus, count(*) as n, round(sum(l_quantity), 2) as quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue from lineitem where l_shipdate <= timestamp '1998-09-02' group by 1, 2""")
def line_summary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").filter("l_shipdate <= timestamp_ntz'1998-09-02'").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum(F.expr("l_extendedprice * (1 - l_discount)")), 2).alias("revenue"))


@query("""select n_name, count(*) as orders, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by n_name""")
def revenue_by_nation(spark: SparkSession, d: str) -> DataFrame:
    t = lambda x: table(spark, d, x)
    j = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(F.count("*").alias("orders"), F.round(F.sum(F.expr("l_extendedprice * (1 - l_discount)")), 2).alias("revenue"))
