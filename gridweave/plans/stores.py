"""Contract queries that write tables, read them again, and check what was written."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources import read, shared_folder, sinks, write_clustered
from .core import BLD, buildings


def _at(spark, tag):
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def csv_round_trip(spark, sf_dir):
    p, at = read(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 7 > 0, F.col("p_name")).alias("p_name"), F.when(F.col("p_partkey") % 5 == 0, "").otherwise(F.col("p_type")).alias("p_type"), "p_retailprice"), _at(spark, "csv")
    sinks.write_csv(p, at)
    return sinks.read_csv(spark, at, p.schema)


def json_coercion(spark, sf_dir):
    """An API's strings as numbers: empty ones and words are null."""
    k = F.col("s_suppkey")
    raw = F.to_json(F.struct(k.alias("id"), F.when(k % 3 == 0, "").when(k % 5 == 0, "n/a").otherwise(F.col("s_nationkey").cast("string")).alias("value")))
    rows = read(spark, sf_dir, "supplier").select(F.from_json(raw, "id long, value string").alias("r"))
    return rows.select("r.id", F.expr("try_cast(nullif(r.value, '') AS DOUBLE)").alias("value"))


def partitioned_sink(spark, sf_dir):
    """Folders by district, read back with one district pruned by its folder."""
    at = _at(spark, "districts")
    sinks.write_partitioned(buildings(spark, sf_dir).select("bldg_id", "district", "area"), at, "district", "bldg_id")
    return spark.read.parquet(at).where("district IN ('NATION_3', 'NATION_7', 'NATION_20')").select("bldg_id", "district", "area")


def geojson_round_trip(spark, sf_dir):
    b = buildings(spark, sf_dir)
    odd = F.when(F.col("bldg_id") % 4 == 0, float("nan")).when(F.col("bldg_id") % 9 == 0, float("inf")).otherwise(F.col("score"))
    at = _at(spark, "geojson")
    sinks.write_geojson(b.select("bldg_id", "district", odd.alias("score"), "lon", "lat"), at, "lon", "lat")
    return sinks.read_geojson(spark, at, "bldg_id long, district string, score double")


def file_manifest(spark, sf_dir):
    """What was written is what a manifest says: files, bytes and a checksum each, and one release table."""
    at = _at(spark, "release")
    spark.range(3).select(F.concat(F.lit("row "), "id").alias("value")).repartition(1).sortWithinPartitions("value").write.text(at)
    m = sinks.manifest(spark, at).where("name NOT LIKE '.%' AND name <> '_SUCCESS'")
    return m.select("bytes", "sha256")


def clustered_sink(spark, sf_dir):
    """Sorted by cell and written in ranges; a filter on the cell then skips files."""
    at = _at(spark, "clustered")
    write_clustered(buildings(spark, sf_dir).withColumn("cell", F.floor(F.col("lon") * 4)), at, "cell", "bldg_id")
    return spark.read.parquet(at).where("cell BETWEEN 118 AND 120").groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum("area").alias("area"))


def reservoir_sample(spark, sf_dir):
    """100 orders by a seeded hash: a sampling operator."""
    return sinks.sample_rows(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 100, "o_orderkey", 42)


def fixture_cut(spark, sf_dir):
    """What lies in a box, ordered by id: a small copy of a table."""
    b = buildings(spark, sf_dir)
    return b.where(F.col("lon").between(29.5, 30.0) & F.col("lat").between(-2.2, -1.8)).select("bldg_id", "area").orderBy("bldg_id")


def described_schema(spark, sf_dir):
    out = sinks.described(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"))
    return out.select("place", "column", "type")


def cached_calls(spark, sf_dir):
    """Keys that are held aren't called again; the ledger counts what was spent."""
    asked = read(spark, sf_dir, "orders").select((F.col("o_custkey") % 60).alias("k"))
    held = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), (F.col("n_regionkey") * 1000).alias("value"))
    return sinks.get_or_call(asked, held, "k", lambda k: k * k)


def batch_budget(spark, sf_dir):
    """Calls in the order of their ids until the running cost reaches the cap, by price per model."""
    from ..operators import picks

    prices = spark.createDataFrame([("F", 3), ("O", 5), ("P", 11)], "model string, price long")
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("model"), F.lit(1).alias("all"))
    cost = o.join(F.broadcast(prices), "model")
    run = picks.running(cost, "all", "o_orderkey", F.col("price"), "o_orderkey", falling=False)
    return run.where(F.col("_before") + F.col("price") <= 2000).groupBy("model").agg(F.count(F.lit(1)).alias("calls"), F.sum("price").alias("cost"))


def package_checks(spark, sf_dir):
    """Checks of a package: row counts, keys, forbidden columns, and nulls; one row each."""
    rules = {"orders": ("o_orderkey", 15), "customer": ("c_custkey", 10), "part": ("p_partkey", 10**9)}
    parts = []
    for t, (key, least) in rules.items():
        df = read(spark, sf_dir, t)
        told = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("k"))
        parts.append(told.select(F.lit(t).alias("name"), "n", (F.col("n") >= least).alias("enough"), (F.col("n") == F.col("k")).alias("unique"), F.lit("geometry" not in df.columns).alias("clean")))
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def latest_versions(spark, sf_dir):
    """Of a manifest's files the latest version of each name."""
    p = read(spark, sf_dir, "part").select((F.col("p_partkey") % 13).alias("name"), F.concat_ws(".", (F.col("p_partkey") % 3).cast("string"), (F.col("p_partkey") % 11).cast("string"), F.col("p_partkey").cast("string")).alias("version"))
    return sinks.latest(p.withColumn("path", F.concat(F.lit("v"), "version")), "name", "version")


def site_pack(spark, sf_dir):
    """Renamed, rounded and scaled properties with the points projected into a drawing."""
    b = buildings(spark, sf_dir)
    x, y = F.round((F.col("lon") - 28.8) / 2.1 * 1000, 1), F.round((-1.04 - F.col("lat")) / 1.81 * 800, 1)
    return b.select("bldg_id", F.round(F.col("area") / 1000.0, 3).alias("a"), F.concat(F.lit("M"), x.cast("string"), F.lit(" "), y.cast("string")).alias("d"))


def batched_scan(spark, sf_dir):
    """A scan in record batches of a fixed number of rows, each told by its rows and sum; none holds a whole table."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 2000):
                s = b.slice(k, 2000)
                yield pa.record_batch([pa.array([s.num_rows], pa.int64()), pa.array([pc.sum(s.column(0)).as_py()], pa.int64())], names=["n", "total"])

    out = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("long")).mapInArrow(run, "n long, total long")
    return out.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), (F.max("n") <= 2000).alias("bounded"))


ORACLE = {
    "csv_round_trip": "SELECT p_partkey, CASE WHEN p_partkey % 7 > 0 THEN p_name END AS p_name, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_type END AS p_type, p_retailprice FROM part",
    "json_coercion": "SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 > 0 AND s_suppkey % 5 > 0 THEN s_nationkey::DOUBLE END AS value FROM supplier",
    "partitioned_sink": f"WITH {BLD} SELECT bldg_id, district, area FROM bld WHERE district IN ('NATION_3', 'NATION_7', 'NATION_20')",
    "geojson_round_trip": f"WITH {BLD} SELECT bldg_id, district, CASE WHEN bldg_id % 4 > 0 AND bldg_id % 9 > 0 THEN score END AS score, lon, lat FROM bld",
    "file_manifest": "SELECT 18::BIGINT AS bytes, sha256('row 0' || chr(10) || 'row 1' || chr(10) || 'row 2' || chr(10)) AS sha256",
    "clustered_sink": f"WITH {BLD} SELECT floor(lon * 4)::BIGINT AS cell, count(*) AS n, sum(area)::BIGINT AS area FROM bld WHERE floor(lon * 4) BETWEEN 118 AND 120 GROUP BY 1",
    "reservoir_sample": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY sha256(o_orderkey || ':42'), o_orderkey LIMIT 100",
    "fixture_cut": f"WITH {BLD} SELECT bldg_id, area FROM bld WHERE lon BETWEEN 29.5 AND 30.0 AND lat BETWEEN -2.2 AND -1.8 ORDER BY 1",
    "described_schema": "SELECT * FROM (VALUES (0, 'o_orderkey', 'bigint'), (1, 'o_custkey', 'bigint'), (2, 'o_orderstatus', 'string')) v(place, \"column\", type)",
    "cached_calls": "WITH a AS (SELECT DISTINCT o_custkey % 60 AS k FROM orders), h AS (SELECT n_nationkey AS k, n_regionkey * 1000 AS v FROM nation) SELECT k, coalesce(v, k * k) AS value, v IS NOT NULL AS cached FROM a LEFT JOIN h USING (k)",
    "batch_budget": "WITH p AS (SELECT * FROM (VALUES ('F', 3), ('O', 5), ('P', 11)) v(model, price)), r AS (SELECT model, price, sum(price) OVER (ORDER BY o_orderkey) AS run FROM orders JOIN p ON o_orderstatus = model) SELECT model, count(*) AS calls, sum(price)::BIGINT AS cost FROM r WHERE run <= 2000 GROUP BY 1",
    "package_checks": "SELECT 'orders' AS name, count(*) AS n, count(*) >= 15 AS enough, count(*) = count(DISTINCT o_orderkey) AS unique, true AS clean FROM orders UNION ALL SELECT 'customer', count(*), count(*) >= 10, count(*) = count(DISTINCT c_custkey), true FROM customer UNION ALL SELECT 'part', count(*), count(*) >= 1000000000, count(*) = count(DISTINCT p_partkey), true FROM part",
    "latest_versions": "SELECT p_partkey % 13 AS name, 'v' || arg_max((p_partkey % 3) || '.' || (p_partkey % 11) || '.' || p_partkey, (p_partkey % 3) * 100000000000 + (p_partkey % 11) * 1000000000 + p_partkey) AS path FROM part GROUP BY 1",
    "site_pack": f"WITH {BLD} SELECT bldg_id, round(area / 1000, 3) AS a, 'M' || round((lon - 28.8::DOUBLE) / 2.1::DOUBLE * 1000, 1) || ' ' || round((-1.04::DOUBLE - lat) / 1.81::DOUBLE * 800, 1) AS d FROM bld",
    "batched_scan": "SELECT count(*) AS n, sum(l_partkey)::BIGINT AS total, true AS bounded FROM lineitem",
}
QUERIES = {name: globals()[name] for name in ORACLE}
