import json
import zipfile

import pytest

from leafmill.sources import blobs
from leafmill.sources.refs import Refs
from leafmill.sources.transport import PermanentError, Transport


@pytest.fixture
def net(tmp_path):
    folder = tmp_path / "recorded"
    folder.mkdir()

    def record(url, body):
        (folder / Transport.name(url)).write_bytes(body if isinstance(body, bytes) else json.dumps(body).encode())

    record.path = str(folder)
    return record


def load(spark, net, **options):
    spark.dataSource.register(Refs)
    return spark.read.format("leafmill_refs").options(recorded=net.path, **options).load()


def item(i):
    return {"id": i, "url": f"https://h.example/{i}.pdf"}


def test_offset(spark, net):
    for k in (0, 100, 200):
        net(f"https://x.example/?o={k}", {"items": [item(i) for i in range(k, min(k + 100, 230))]})
    df = load(spark, net, connector="worldbank", url="https://x.example/?o={offset}", total="230")
    assert df.count() == 230 and df.rdd.getNumPartitions() == 3
    assert load(spark, net, connector="worldbank", url="https://x.example/?o={offset}").count() == 230
    assert load(spark, net, connector="worldbank", url="https://x.example/?o={offset}", limit="7").count() == 7


def test_cursor_and_missing_items(spark, net):
    net("https://x.example/?c=", {"items": [item(1)], "next": "b"})
    net("https://x.example/?c=b", {"items": [item(2)], "next": None})
    assert sorted(r["source_id"] for r in load(spark, net, connector="openalex", url="https://x.example/?c={cursor}").collect()) == ["1", "2"]
    net("https://y.example/?c=", {"error": "busy"})
    with pytest.raises(Exception, match="has no items"):
        load(spark, net, connector="openalex", url="https://y.example/?c={cursor}").collect()


def test_windows_are_halved(spark, net):
    u = "https://x.example/{start}_{end}"
    net(u.format(start="2020-01-01", end="2020-12-31"), {"items": [item(0)], "total": 3})
    net(u.format(start="2020-01-01", end="2020-07-01"), {"items": [item(1), item(2)], "total": 2})
    net(u.format(start="2020-07-02", end="2020-12-31"), {"items": [item(3)], "total": 1})
    net(u.format(start="2021-01-01", end="2021-03-01"), {"items": [], "total": 0})
    df = load(spark, net, connector="ntrs", url=u, start="2020-01-01", end="2021-03-01")
    assert sorted(r["source_id"] for r in df.collect()) == ["1", "2", "3"]


def test_windows_are_paged(spark, net):
    u, day = "https://x.example/{start}_{end}?o={offset}", "2020-01-01"
    ids = lambda **o: sorted(int(r["source_id"]) for r in load(spark, net, **({"url": u, "start": day, "end": day} | o)).collect())
    for k in (0, 100, 200):
        net(u.format(start=day, end=day, offset=k), {"items": [item(i) for i in range(k, min(k + 100, 230))], "total": 230})
    assert ids(connector="ntrs") == list(range(230)) and ids(connector="ntrs", limit="120") == list(range(120))
    # Without a total: to a page that isn't full; a full one may also be the last.
    v = "https://y.example/{start}_{end}?o={offset}"
    for k, n in ((0, 2000), (2000, 2000), (4000, 0)):
        net(v.format(start=day, end=day, offset=k), {"items": [item(i) for i in range(k, k + n)]})
    assert ids(connector="eurlex", url=v) == list(range(4000))
    # An answer that is whole, however many records it holds.
    w = "https://w.example/{start}_{end}"
    net(w.format(start=day, end=day), {"items": [item(i) for i in range(300)]})
    assert ids(connector="edinet", url=w) == list(range(300))


def test_windows_beyond_the_limit_of_the_source(spark, net):
    u, days = "https://x.example/{start}_{end}?o={offset}", ("2020-01-01", "2020-01-02")
    read = lambda **o: load(spark, net, **({"connector": "ntrs", "url": u, "start": days[0], "end": days[1]} | o))
    net(u.format(start=days[0], end=days[1], offset=0), {"items": [item(i) for i in range(100)], "total": 10_001})
    for k, day in enumerate(days):
        for o in (0, 100):
            net(u.format(start=day, end=day, offset=o), {"items": [item(1000 * k + i) for i in range(o, min(o + 100, 150))], "total": 150})
    assert sorted(int(r["source_id"]) for r in read(start=days[0], step="month").collect()) == [*range(150), *range(1000, 1150)]
    net(u.format(start=days[1], end=days[1], offset=0), {"items": [item(i) for i in range(100)], "total": 10_001})
    with pytest.raises(Exception, match="2020-01-02 alone holds more"):
        read().collect()
    # Without an offset and a total nobody knows whether a full answer is all.
    v = "https://y.example/{start}_{end}"
    net(v.format(start=days[0], end=days[1]), {"items": [item(i) for i in range(100)]})
    net(v.format(start=days[0], end=days[0]), {"items": [item(i) for i in range(60)]})
    net(v.format(start=days[1], end=days[1]), {"items": [item(i) for i in range(60, 130)]})
    assert read(url=v).count() == 130
    net(v.format(start=days[1], end=days[1]), {"items": [item(i) for i in range(60, 160)]})
    with pytest.raises(Exception, match="alone holds more"):
        read(url=v).collect()
    net(v.format(start=days[1], end=days[1]), {"items": [item(i) for i in range(60, 160)], "total": 101})
    with pytest.raises(Exception, match="100 of 101"):
        read(url=v).collect()


def test_xml_sitemap_seeds_generated_archive(spark, net, tmp_path):
    net("https://x.example/?o=0", b'<feed xmlns="urn:a"><entry><id>e1</id><url>https://h.example/e1.pdf</url></entry></feed>')
    assert load(spark, net, connector="arxiv", url="https://x.example/?o={offset}").first()["source_id"] == "e1"
    net("https://x.example/map.xml", b'<urlset xmlns="urn:s"><url><loc>https://h.example/a.pdf</loc></url><url><loc>https://h.example/b.html</loc></url></urlset>')
    assert [r["source_id"] for r in load(spark, net, connector="bis", url="https://x.example/map.xml").collect()] == ["a"]
    net("https://z.example/", b'<a href="/i/1.html">x</a><a href="a.pdf">x</a><a href="a.pdf#p">x</a>')
    net("https://z.example/i/1.html", b'<a href="b.pdf">x</a>')
    seeds = tmp_path / "seeds"
    seeds.write_text("# note\nhttps://z.example/ | free | zines | follow=/i/ | max=5\n")
    got = {(r["url"], r["license"], r["discovery_query"]) for r in load(spark, net, connector="magazine_archives", seeds=str(seeds)).collect()}
    assert got == {("https://z.example/a.pdf", "free", "zines"), ("https://z.example/i/b.pdf", "free", "zines")}
    assert load(spark, net, connector="state_bills", url="https://b.example/{state}/{n}.pdf", state="ny,ca", n="1,2,3").count() == 6
    with zipfile.ZipFile(tmp_path / "v.zip", "w") as z:
        z.writestr("d/1.pdf", b"%PDF-1.4 body")
        z.writestr("d/2.pdf", b"no such thing")
    assert [r["source_id"] for r in load(spark, net, connector="govdocs1", archives=str(tmp_path / "*.zip")).collect()] == ["1"]


def test_nothing_is_cut_without_a_limit(spark, net, tmp_path):
    net("https://z.example/", "".join(f'<a href="{i}.pdf">x</a>' for i in range(401)).encode())
    seeds = tmp_path / "seeds"
    seeds.write_text("https://z.example/\n")
    assert load(spark, net, connector="magazine_archives", seeds=str(seeds)).count() == 401
    assert load(spark, net, connector="magazine_archives", seeds=str(seeds), limit="0").count() == 0
    bills = {"connector": "state_bills", "url": "https://b.example/{state}/{chamber}{number}{version}.pdf", "state": "tx", "chamber": "HB,SB", "version": "I,E"}
    assert load(spark, net, **bills).select("url").distinct().count() == 2500 * 2 * 2
    assert load(spark, net, **bills, number=",".join(map(str, range(3000)))).count() == 3000 * 2 * 2
    for k in range(11):
        net(f"https://x.example/?c={k or ''}", {"items": [item(1000 * k + i) for i in range(1000)], "next": str(k + 1) if k < 10 else None})
    pmc = {"connector": "pmc_oa", "url": "https://x.example/?c={cursor}"}
    assert load(spark, net, **pmc).count() == 11_000 and load(spark, net, **pmc, limit="1500").count() == 1500


def test_followed_pages_stay_bounded(spark, net, tmp_path):
    net("https://z.example/", "".join(f'<a href="/i/{i}">x</a>' for i in range(402)).encode())
    for i in range(402):
        net(f"https://z.example/i/{i}", f'<a href="/{i}a.pdf">x</a><a href="/{i}b.pdf">x</a>'.encode())
    seeds = tmp_path / "seeds"
    seeds.write_text("https://z.example/ | | | follow=/i/\n")
    assert load(spark, net, connector="magazine_archives", seeds=str(seeds)).count() == 800


def test_terms_and_options(spark, net):
    for options in ({"connector": "hkex", "url": "u", "start": "2020-01-01", "end": "2020-01-02"}, {"connector": "none"}):
        with pytest.raises(Exception, match="accept|must be one"):
            load(spark, net, **options).collect()
    with pytest.raises(ValueError, match="user_agent"):
        Transport()
    with pytest.raises(PermanentError):
        Transport(user_agent="t", robots=False).get("file:///etc/hosts")


def test_fetch_and_verify(spark, net, tmp_path):
    net("https://h.example/1.pdf", b"%PDF-1.4 one")
    net("https://h.example/2.pdf", b"<html>")
    rows = [(1, "https://h.example/1.pdf"), (2, "https://h.example/2.pdf"), (3, "https://h.example/3.pdf"), (4, None), (5, "https://h.example/1.pdf")]
    root = str(tmp_path / "store")
    got = {r["doc_id"]: r for r in blobs.fetch(spark.createDataFrame(rows, "doc_id long, url string"), root, 2, recorded=net.path).collect()}
    assert [got[i]["ok"] for i in range(1, 6)] == [True, False, False, False, True] and {got[2]["kind"], got[3]["kind"]} == {"permanent"}
    sha = got[1]["sha256"]
    docs = spark.createDataFrame([(1, sha, "stored"), (6, "0" * 64, "stored"), (7, None, "failed")], "doc_id long, sha256 string, status string")
    assert {r["doc_id"]: r["state"] for r in blobs.verify(spark, root, docs).collect()} == {1: "ok", 6: "missing"}
    with open(blobs.shard_path(root, sha), "ab") as f:
        f.write(b"x")
    assert blobs.verify(spark, root, docs).filter("doc_id = 1").first()["state"] == "mismatched"


def test_selection(spark, tmp_path):
    df = spark.createDataFrame([("b", [3, 1, 3]), ("a", [2]), ("c", [])], "sha256 string, pages array<int>")
    out = blobs.selection_rows(df)
    assert sorted(tuple(r) for r in out.collect()) == [("v2_00000", "a", 2), ("v2_00001", "b", 1), ("v2_00002", "b", 3)]
    blobs.write_jsonl(out, str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).count() == 3
