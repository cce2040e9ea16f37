"""Seeds, referrers and duplicates, also where one key holds most of the rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from webstrata import dedupe_captures, resolve_seed, via_join
from webstrata.operators import lineage
from webstrata.operators.lineage import lookup

SCHEMA = "uri string, via string, is_seed boolean, crawl_time timestamp_ntz, status int"
T0 = dt.datetime(2024, 1, 1)


def brute_force(rows, steps=50):
    by_uri = {r[0]: r for r in rows}
    out = {}
    for uri, via, *_ in rows:
        at, left = by_uri.get(via), steps
        while at is not None and not at[2]:
            if left == 0:
                break
            at, left = by_uri.get(at[1]), left - 1
        out[uri] = at[0] if at is not None and at[2] else ""
    return out


def chain():
    rows = [("p0", None, True, T0, 200)]
    rows += [(f"p{i}", f"p{i - 1}", False, T0, 200) for i in range(1, 60)]
    return rows + [("p100", "p101", False, T0, 200), ("p101", "p100", False, T0, 200), ("lost", "gone", None, T0, 200)]


def test_chain_and_cycle(spark):
    rows = chain()
    got = {r.uri: r.seed_url for r in resolve_seed(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute_force(rows)
    assert [k for k in got if got[k] == "p0"] and all(got[f"p{i}"] == "p0" for i in range(1, 52))
    assert all(got[k] == "" for k in ["p0", "p52", "p59", "p100", "p101", "lost"])


def test_steps(spark):
    df = spark.createDataFrame(chain(), SCHEMA)
    for steps in (0, 1, 2, 7):
        got = {r.uri for r in resolve_seed(df, steps=steps).where("seed_url = 'p0'").collect()}
        assert got == {f"p{i}" for i in range(1, steps + 2)}


@pytest.fixture
def shuffled(spark):
    """Joins as on large tables: none is small enough to be broadcast, and partitions are large from 20 kB on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


def test_hub_with_most_of_the_pages(spark, shuffled):
    rows = [("seed", None, True, T0, 200), ("hub", "seed", False, T0, 200), ("seed2", "hub", True, T0, 404)]
    rows += [(f"a{i}", "hub", False, T0, 200) for i in range(2000)]
    rows += [(f"b{i}", f"a{i % 30}", False, T0, 200) for i in range(700)]
    rows += [(f"c{i}", f"b{i % 9}" if i % 3 else "seed2", False, T0, 200) for i in range(500)]
    rows += [(f"d{i}", None, False, T0, 200) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.uri: r.seed_url for r in resolve_seed(df).collect()}
    assert got == brute_force(rows)
    out = via_join(df, ("status",))
    status = {r[0]: r[4] for r in rows}
    assert {r.uri: r.via_status for r in out.collect()} == {r[0]: status.get(r[1]) for r in rows}


def test_recrawls_keep_their_rows(spark):
    rows = [
        ("s", None, True, T0, 200),
        ("p", "old", False, T0, 200),
        ("p", "s", False, T0 + dt.timedelta(1), 404),
        ("q", "p", False, T0, 200),
        ("q", "p", False, T0, 200),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.uri, r.via, r.seed_url) for r in resolve_seed(df).collect())
    assert got == [("p", "old", ""), ("p", "s", "s"), ("q", "p", "s"), ("q", "p", "s"), ("s", None, "")]
    got = sorted((r.uri, r.via_status or 0) for r in via_join(df, ("status",)).collect())
    assert got == [("p", 0), ("p", 200), ("q", 404), ("q", 404), ("s", 0)]


def walked(rows):
    """(uri, time) -> status and time of the referring capture, and the seed; one capture per URI and time."""
    def referrer(row):
        captures = sorted((r for r in rows if r[0] == row[1]), key=lambda r: r[3])
        before = [r for r in captures if r[3] < row[3]]
        return (before or captures or [None])[-1]

    out = {}
    for row in rows:
        first = at = referrer(row)
        for _ in range(50):
            at = at if at is None or at[2] else referrer(at)
        out[row[0], row[3]] = (first and first[4], first and first[3], at[0] if at and at[2] else "")
    return out


@pytest.mark.parametrize("block_rows", [lineage.BLOCK_ROWS, 40])
def test_the_referring_capture_is_the_last_one_before(spark, shuffled, monkeypatch, block_rows):
    monkeypatch.setattr(lineage, "BLOCK_ROWS", block_rows)
    hour = dt.timedelta(hours=1)
    # a hub is captured again and again, reached from one of three seeds, and has children all the time
    rows = [(f"s{i}", None, True, T0 - hour, 200) for i in range(3)]
    rows += [("hub", f"s{i % 3}", False, T0 + 7 * i * hour, 200 + i) for i in range(30)]
    rows += [(f"c{i}", "hub", False, T0 + (i - 5) * hour, 200) for i in range(230)]
    rows += [(f"d{i}", f"c{i}", False, T0 + (i - 5 + i % 2) * hour, 200) for i in range(230)]
    # two URIs that are each other's referrers
    rows += [(f"t{i % 2}", "s1" if i == 0 else f"t{1 - i % 2}", False, T0 + i * hour, 300 + i) for i in range(20)]
    df, want = spark.createDataFrame(rows, SCHEMA), walked(rows)
    out = via_join(df, ("status", "crawl_time")).collect()
    assert len(out) == len(rows) and {(r.uri, r.crawl_time): (r.via_status, r.via_crawl_time) for r in out} == {k: v[:2] for k, v in want.items()}
    out = resolve_seed(df).collect()
    assert len(out) == len(rows) and {(r.uri, r.crawl_time): r.seed_url for r in out} == {k: v[2] for k, v in want.items()}


def test_without_times_the_referrer_is_one_capture(spark):
    df = spark.createDataFrame(chain(), SCHEMA).drop("crawl_time")
    assert {r.uri: r.seed_url for r in resolve_seed(df).collect()} == brute_force(chain())
    again = df.unionByName(df.selectExpr("uri", "via", "is_seed", "status + 1 status"))
    assert {r.via_status for r in via_join(again, ("status",)).where("via like 'p%'").collect()} == {201}
    assert via_join(again, ("status",)).count() == again.count()


def test_lookup_is_a_left_join(spark, shuffled):
    facts = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 900).cast("string")).alias("k")
    )
    dim = spark.range(0, 900, 2).select(F.col("id").cast("string").alias("key"), (F.col("id") * 2).alias("v"))
    dim = dim.unionByName(spark.createDataFrame([("hot", 7), ("none", 8)], "key string, v long"))
    got = lookup(facts, "k", dim, "key")
    want = facts.join(dim, F.col("k") == F.col("key"), "left").drop("key")
    assert got.columns == ["id", "k", "v"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_key_with_most_of_the_facts_is_split(spark, shuffled):
    facts = spark.range(0, 60_000, numPartitions=12).selectExpr("id", "if(id % 3 > 0, 'hot', cast(id as string)) k")
    dim = spark.range(60_000).selectExpr("cast(id as string) key", "id * 2 v").unionByName(spark.createDataFrame([("hot", 7)], "key string, v long"))
    joined = lookup(facts, "k", dim, "key")
    assert "SortMergeJoin(skew=true)" in final_plan(joined) and joined.where("k = 'hot' AND v = 7").count() == 40_000


def test_lineage_reads_bodies_once_and_the_rest_once(spark, tmp_path):
    path = str(tmp_path / "captures")
    spark.createDataFrame(chain(), SCHEMA).selectExpr("*", "repeat(uri, 100) body").write.parquet(path)
    captures = spark.read.parquet(path)
    resolved = resolve_seed(captures)
    plan = resolved._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [uri") == 1  # the join with the seeds; all else reads the narrow table
    joined = via_join(captures, ("status",))._jdf.queryExecution().executedPlan().toString()
    read = [line for line in joined.splitlines() if "ReadSchema" in line]
    assert len(read) == 2 and sum("body" in line.split("ReadSchema")[1] for line in read) == 1


def test_dedupe(spark):
    rows = [
        ("u1", "http://a.com", T0),
        ("u2", "http://www.a.com/index.html#x", T0 + dt.timedelta(2)),
        ("u3", "http://a.com/x/../", T0 + dt.timedelta(1)),
        ("u4", "http://a.com/?q", T0),
        ("u5", "nothing", T0),
        ("u6", "else", T0),
        ("u7", None, T0),
        ("u9", "http://b.com/", None),
        ("u8", "http://b.com/", None),
    ]
    df = spark.createDataFrame(rows, "uri string, url string, crawl_time timestamp_ntz")
    got = sorted((r.uri, r.canonical_url) for r in dedupe_captures(df).collect())
    assert got == [
        ("u2", "http://www.a.com/"), ("u4", "http://www.a.com/?q"), ("u5", "nothing"), ("u6", "else"),
        ("u7", "u7"), ("u8", "http://www.b.com/"),
    ]


def test_dedupe_drops_copies_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("cast(id as string) uri", "concat('http://a.com/', id % 2) url", "timestamp_ntz'2024-01-01' crawl_time")
    plan = dedupe_captures(df)._jdf.queryExecution().executedPlan().toString()
    partial, final = plan.index("Partial"), plan.index("Final")
    assert "WindowGroupLimit" in plan and final < plan.index("Exchange hashpartitioning") < partial


def recrawled(spark, tmp_path, most):
    """Few pages of many captures, or many pages of few, as a table; with bodies that ties of URI and time tell apart."""
    df = spark.range(2000).selectExpr(
        "concat('u', id % 900) uri", f"concat('http://', if(id % 2 = 0, 'www.', ''), 'h', id % {most}, '.com/') url",
        "timestamp_ntz'2024-01-01' + make_dt_interval(id % 5) crawl_time", "cast(repeat(cast(id as string), 50) as binary) response",
    )
    df.unionByName(df.limit(40)).write.parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t"))


@pytest.mark.parametrize("most", [7, 1900])
def test_dedupe_of_a_table_fetches_bodies_last(spark, tmp_path, shuffled, most):
    table = recrawled(spark, tmp_path, most)
    kept = dedupe_captures(table.where("url is not null"), late_bytes=0)
    assert kept.columns == [*table.columns, "canonical_url"]
    rows = kept.collect()
    by_rows = dedupe_captures(table)  # small: ranked as whole rows
    assert sorted((r.canonical_url, r.uri, r.crawl_time) for r in rows) == sorted((r.canonical_url, r.uri, r.crawl_time) for r in by_rows.collect())
    known = {(r.uri, r.url, r.crawl_time, bytes(r.response)) for r in table.collect()}
    assert all((r.uri, r.url, r.crawl_time, bytes(r.response)) in known for r in rows)
    plan = final_plan(kept)
    assert ("LeftSemi" if most == 7 else "LeftAnti") in plan and "Window" not in plan


def test_dedupe_ranks_narrow_rows(spark, tmp_path, monkeypatch):
    from webstrata.operators import dedupe

    ranked = []
    monkeypatch.setattr(dedupe, "materialize", lambda df, name: (ranked.append(df), df)[1])
    table = recrawled(spark, tmp_path, 7)
    dedupe_captures(table, late_bytes=0).count()
    plan = ranked[0]._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "response" not in plan
    # rows that share a place in a file, or may differ when read again, are ranked as they are
    exploded = table.selectExpr("*", "explode(array(1, 2)) part").withColumn("url", F.concat("url", F.col("part").cast("string")))
    for other in (exploded, table.where("rand() >= 0"), table.unionByName(table), table.repartition(3)):
        pages = dedupe_captures(other).select("canonical_url").collect()
        assert sorted(dedupe_captures(other, late_bytes=0).select("canonical_url").collect()) == sorted(pages) and len(set(pages)) == len(pages)
    assert len(ranked) == 1
