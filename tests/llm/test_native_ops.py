"""Operators 2, 3 and 4: oracle parity and edge cases."""

import random
import zlib
from datetime import date

import duckdb
import pytest

from mcqflow.llm import quality_rules, queries, sharding, sql, urlfilter

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_ngram_jaccard_join", "op2_url_filter", "op3_quality_rules", "op4_sharding", "op8_substring_dedup"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    cur = con.execute(sql.ORACLE[name])
    names = [d[0] for d in cur.description]
    exp = sorted((tuple(dict(zip(names, r))[c] for c in cols) for r in cur.fetchall()), key=repr)
    assert sorted(names) == cols and got == exp


def test_url_filter_intervals_and_edges(spark):
    d = date.fromisoformat
    caps = spark.createDataFrame(
        [(1, "https://a.b.example.com/x", d("2024-01-05"), "k"), (2, "https://a.b.example.com/x", d("2024-02-05"), "k"),
         (3, "https://a.b.example.com/x", d("2023-12-31"), "k"), (4, None, d("2024-01-05"), "k"), (5, "nonsense", d("2024-01-05"), "k"),
         (6, "http://user@EXAMPLE.com:80?q", d("2024-01-05"), "k"), (7, "http://c.example.com", None, "k"), (7, "http://c.example.com", None, "k")],
        "page_id long, url string, fetched_at date, blocked string")
    ents = spark.createDataFrame(
        [("example.com", d("2024-01-01"), "block"), ("b.example.com", d("2024-02-01"), "allow"),
         (None, d("2024-01-01"), "block"), ("x.org", None, "block"), ("example.com", d("2024-01-01"), "allow")],
        "domain string, listed_at date, status string")
    got = sorted((r.page_id, r.matched, r.blocked) for r in urlfilter.filter_urls(caps, ents).collect())
    assert got == sorted([(1, "example.com", True), (2, "b.example.com", False), (3, None, False), (4, None, False),
                          (5, None, False), (6, "example.com", True), (7, None, False), (7, None, False)], key=lambda r: (r[0], str(r[1]), r[2]))
    assert urlfilter.filter_urls(caps, ents.limit(0)).where("blocked").count() == 0
    assert urlfilter.filter_urls(caps.limit(0), ents).count() == 0


def test_as_of_against_loops(spark):
    """Many times and entries of few domains, times equal to an entry's, unlisted domains, other types of time."""
    rng = random.Random(9)
    entries = sorted({(f"d{rng.randint(0, 3)}", rng.randint(0, 400)): rng.random() < 0.5 for _ in range(200)}.items())
    asked = sorted({(f"d{rng.randint(0, 5)}", rng.randint(-20, 420)) for _ in range(900)})
    ents = spark.createDataFrame([(d, t, "block" if b else "allow") for (d, t), b in entries], "domain string, listed_at long, status string")
    got = urlfilter.as_of(spark.createDataFrame(asked, "domain string, at int"), urlfilter.validity(ents)).collect()
    want = {}
    for d, t in asked:
        for (e, since), blocks in entries:
            if e == d and since <= t:
                want[d, t] = (since, blocks)
    assert {(r.domain, r.at): (r.entry.valid_from, r.entry.blocks) for r in got} == want and len(got) == len(want)


def test_quality_rules_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a b c d e f g h i j k"), (4, "x y z u v " * 4000), (4, "x y z u v " * 4000),
            (5, "w1 w2 w3 w4 w5 w6 w1 w2 w3 w4 w5 q"), (6, "l one\n\nl one\nl two\n \n \n")]
    got = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[k].n_words for k in (1, 2, 3, None, 4)] == [0, 0, 0, 11, 20000]
    assert got[1].base_failed and not got[1].kept and got[4].n_repeat_words == 20000 and got[4].base_failed
    assert got[5].n_repeat_words == 10 and got[6].n_dup_lines == 1 and got[6].word_chars == 12
    assert quality_rules.judge(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_shards_are_contiguous_balanced_and_gapless(spark):
    rows = [(i, "x" * (i * 37 % 400)) for i in range(500)] + [(None, None), (7, "dup"), (7, "dup"), (8, "é" * 10)]
    got = sharding.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 504
    crc = {(r.doc_id, r.size, r.text_crc32) for r in got}
    assert (8, 21, zlib.crc32(("é" * 10).encode())) in crc and (None, 1, 0) in crc
    total = sum(r.size for r in got)
    for s in range(8):
        own = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / 8) <= 401
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [key(r) for r in order] == sorted(key(r) for r in got)
    assert sharding.report(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    extra = spark.createDataFrame([(1, 5, "a")], "doc_id long, size long, shard string")
    assert sharding.assign(extra, order=("doc_id",)).columns == ["doc_id", "size", "shard", "slot", "offset"]


def test_url_filter_takes_top_level_domains(spark):
    d = date.fromisoformat
    urls = ["http://a.b.zip/x", "http://zip", "http://good.zip", "http://x.good.zip", "http://zip.org", "http://10.0.0.7", "http://b.zip."]
    caps = spark.createDataFrame([(k, u, d("2024-01-05")) for k, u in enumerate(urls)], "page_id long, url string, fetched_at date")
    ents = spark.createDataFrame([("zip", d("2024-01-01"), "block"), ("good.zip", d("2024-01-01"), "allow"), ("7", d("2024-01-01"), "block")],
                                 "domain string, listed_at date, status string")
    got = {r.page_id: (r.matched, r.blocked) for r in urlfilter.filter_urls(caps, ents).collect()}
    assert got == {0: ("zip", True), 1: ("zip", True), 2: ("good.zip", False), 3: ("good.zip", False), 4: (None, False), 5: (None, False), 6: (None, False)}
