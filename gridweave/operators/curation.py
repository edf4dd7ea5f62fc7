"""Groups of records that are linked with each other, and checks of quoted text."""

from __future__ import annotations

import math
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import METRES, metres
from ..sources import settled


def linked_groups(nodes: DataFrame, edges: DataFrame, id_col: str, rounds: int = 60) -> DataFrame:
    """(id, group): the least id that each node reaches over edges (u, v) between nodes.

    Alternates large and small stars: each round links a node's greater neighbours, and then its lesser ones, to the
    least of them, so that the rounds grow with the logarithm of a chain's length and not with the length. Each round's
    edges are written to the shared folder. Raises if `rounds` don't settle it.
    """
    ids = nodes.select(F.col(id_col).alias("id"))
    ends = edges.where("u != v").select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct()
    known = lambda df, c: df.join(ids, F.col(c) == F.col("id"), "left_semi")
    now, before = settled(known(known(ends, "hi"), "lo")), None
    for _ in range(rounds):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if not state[0] or state == before:
            return ids.join(now, F.col("id") == F.col("hi"), "left").select(F.col("id").alias(id_col), F.coalesce("lo", "id").alias("group"))
        before = state
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(down, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = settled(small.unionAll(down.select("hi", F.col("m").alias("lo"))).distinct())
    raise RuntimeError(f"groups did not settle in {rounds} rounds")


#: Halves of the cells at most two rows and columns away: each pair of near cells once.
HALF = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if (i, j) > (0, 0)]


def near_groups(points: DataFrame, id_col: str, radius: float, lat0: float, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """(id, group): the least id that each point reaches by steps of `radius` metres at most.

    Cells are so small that all points of one are in reach of each other, so a cell is one node and no pair inside it is
    made. Two near cells are linked if two of their outermost points (of eight directions) are in reach, and aren't if
    their boxes are out of reach; only for the rest are points paired, those in reach of the other's box. So the edges
    grow with the cells and not with the pairs. A point without finite coordinates stands alone.
    """
    side, per_lon = radius / math.sqrt(2) * (1 - 1e-6), METRES * math.cos(math.radians(lat0))
    x, y = F.col("lon") * per_lon, F.col("lat") * METRES
    own = points.select(F.col(id_col).alias("id"), F.col(lon).alias("lon"), F.col(lat).alias("lat"))
    finite = (F.abs(x) < 1e12) & (F.abs(y) < 1e12)
    own = settled(own.withColumn("cx", F.when(finite, F.floor(x / side))).withColumn("cy", F.when(finite, F.floor(y / side))))
    spots = own.where("cx IS NOT NULL")
    at = F.struct("lon", "lat")
    outer = F.array_distinct(F.array(*(F.max_by(at, i * x + j * y) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j)))
    ends = (f(c).alias(f"{f.__name__}_{c}") for c in ("lon", "lat") for f in (F.min, F.max))
    cells = settled(spots.groupBy("cx", "cy").agg(F.min("id").alias("u"), outer.alias("outer"), *ends))

    far = cells.select(*(F.col(c).alias({"u": "v"}.get(c, f"r_{c}")) for c in cells.columns))
    shifted = cells.withColumn("_d", F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in HALF))))
    pairs = shifted.join(far, (F.col("cx") + F.col("_d.i") == F.col("r_cx")) & (F.col("cy") + F.col("_d.j") == F.col("r_cy")))
    gap = lambda lo, hi, r_lo, r_hi: F.greatest(r_lo - hi, lo - r_hi, F.lit(0.0))
    box = lambda p: [F.col(f"{p}{f}_{c}") for c in ("lon", "lat") for f in ("min", "max")]
    reach = lambda a, b: F.hypot(gap(*a[:2], *b[:2]) * per_lon, gap(*a[2:], *b[2:]) * METRES) <= radius * (1 + 1e-9)
    touch = F.exists("outer", lambda p: F.exists("r_outer", lambda q: metres(p["lon"], p["lat"], q["lon"], q["lat"], lat0) <= radius))
    told = settled(pairs.where(reach(box(""), box("r_"))).withColumn("near", touch).drop("_d", "outer", "r_outer"))

    def held(p: str, other: str) -> DataFrame:
        """The places of one of two cells that are in reach of the other's box."""
        unsure = told.where("NOT near").select("u", "v", F.col(f"{p}cx").alias("cx"), F.col(f"{p}cy").alias("cy"), *box(other))
        point = [F.col("lon"), F.col("lon"), F.col("lat"), F.col("lat")]
        return unsure.join(spots, ["cx", "cy"]).where(reach(point, box(other))).select("u", "v", F.col("lon").alias(f"{p}lon"), F.col("lat").alias(f"{p}lat")).distinct()

    paired = held("", "r_").join(held("r_", ""), ["u", "v"])
    found = paired.where(metres(F.col("lon"), F.col("lat"), F.col("r_lon"), F.col("r_lat"), lat0) <= radius)
    groups = linked_groups(cells.select("u"), told.where("near").select("u", "v").unionAll(found.select("u", "v")), "u")
    named = cells.join(groups, "u").select("cx", "cy", "group")
    return own.join(named, ["cx", "cy"], "left").select(F.col("id").alias(id_col), F.coalesce("group", "id").alias("group"))


@F.pandas_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def folded(text: Column) -> Column:
    """plain_text() after compatibility folding (NFKC): wide and joined letters, ligatures, odd blanks. Arrow batches."""
    return plain_text(_nfkc(text))


def sorted_map(m: Column) -> Column:
    """A map with its entries in the order of their keys, so that equal maps give one JSON text."""
    return F.map_from_entries(F.array_sort(F.map_entries(m)))


def plain_text(text: Column) -> Column:
    """Folds dashes, quotes and common ligatures, drops soft hyphens, joins words cut at line ends, squeezes white space."""
    out = F.translate(text, "‐‑‒–—−‘’‚“”„ ­", "------'''\"\"\" ")  # the last one, a soft hyphen, is dropped
    for mark, plain in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl")):
        out = F.replace(out, F.lit(mark), F.lit(plain))
    out = F.regexp_replace(out, r"(?U)(\w)-\s*\n\s*(\w)", "$1$2")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def quote_holds(quote: Column, page: Column, following: Column) -> Column:
    """Whether the quote stands on the page, or runs from it onto the following one; on the following alone doesn't count."""
    nxt = F.coalesce(following, F.lit(""))
    q, p, f, both = plain_text(quote), plain_text(page), plain_text(nxt), plain_text(F.concat(page, F.lit("\n"), nxt))
    return (q != "") & (F.contains(p, q) | (F.contains(both, q) & ~F.contains(f, q)))


def keyword_hits(text: Column, words: list[str]) -> Column:
    """How many of the words the text holds, in any case."""
    low = F.lower(text)
    return sum((F.contains(low, F.lit(w)).cast("int") for w in words), F.lit(0))
