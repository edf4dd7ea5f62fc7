"""Secret scans through a trigram inverted index, with DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, apart, table


@dataclass(frozen=True)
class Rule:
    """A pattern in Java's syntax; matches whose `group` has fewer than `least` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Base rules, in the order that breaks ties; fixed values. `access` and `hex` carry their least lengths in the pattern:
#: a maximal run that is too short holds no longer match, so that dropping it later comes to the same.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: Further public formats of credentials.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[sr]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)
MARK = "[SECRET]"
MOST = 16  # strings that an exact prefix is followed as, before it is split
SPAN = "array<struct<start:int,rank:int,end:int,at:int,to:int>>"  # at and to in bytes, the others in code points
PIECE = 128  # entries of an array that are folded at once, so that long ones don't cost their square


def _exact(tree) -> set[str] | None:
    """All strings, in lower case, that a part of a pattern matches, if they are few; else None."""
    from re import _constants as k  # type: ignore[attr-defined]

    found = {""}
    for op, arg in tree:
        if op is k.LITERAL:
            own = {chr(arg).lower()}
        elif op is k.IN and all(o is k.LITERAL for o, _ in arg):
            own = {chr(c).lower() for _, c in arg}
        elif op is k.SUBPATTERN:
            own = _exact(arg[3])
        elif op is k.BRANCH:
            parts = [_exact(x) for x in arg[1]]
            own = None if None in parts else set().union(*parts)
        elif op is k.MAX_REPEAT and arg[1] <= 2 and (one := _exact(arg[2])) is not None:
            own = {"".join(x) for n in range(arg[0], arg[1] + 1) for x in product(one, repeat=n)}
        else:
            return None
        if own is None or len(found) * len(own) > MOST:
            return None
        found = {a + b for a, b in product(found, own)}
    return found


def _grams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The Boolean query that every match implies, over the lower-cased text: an OR of ANDs of trigrams.

    A run of parts with few possible strings demands the trigrams of one of them; of all runs, the most telling one is
    taken. An empty list means that nothing is mandatory.
    """
    from re import _constants as k  # type: ignore[attr-defined]
    from re import _parser  # type: ignore[attr-defined]

    def runs(tree) -> list[set[str]]:
        out, now = [], {""}
        for op, arg in tree:
            own = _exact([(op, arg)])
            if own is not None and len(now) * len(own) <= MOST:
                now = {a + b for a, b in product(now, own)}
                continue
            out.append(now)
            now = own if own is not None else {""}
            if own is None and op is k.SUBPATTERN:
                out += runs(arg[3])
            elif own is None and op is k.MAX_REPEAT and arg[0]:
                out += runs(arg[2])
        return [*out, now]

    queries = [{_grams(s) for s in strings} for strings in runs(_parser.parse(pattern))]
    queries = [q for q in queries if all(q)]  # a string under three characters demands nothing
    best = max(queries, key=lambda q: (min(map(len, q)), -len(q)), default=set())
    return sorted((q for q in best if not any(o < q for o in best)), key=sorted)


def _let(x: Column, f) -> Column:
    """f of x, with x computed once."""
    return F.transform(F.array(x), f)[0]


def _before(items: Column, own, join, zero: int = 0) -> Column:
    """For each entry of an array, what join() makes of zero and own() of the entries before it (join: sum, greatest).

    Pieces of PIECE entries are folded by themselves, from what the pieces before them give; so no array is copied
    once for each of its entries.
    """
    pieces = F.when(F.size(items) > 0, F.sequence(F.lit(0), ((F.size(items) - 1) / PIECE).cast("int"))).otherwise(F.array().cast("array<int>"))
    piece = lambda b: F.slice(items, b * PIECE + 1, F.lit(PIECE))
    add = lambda acc, x: F.concat(acc, F.array(join(F.element_at(acc, -1), x)))
    sums = F.transform(pieces, lambda b: F.aggregate(piece(b), F.lit(zero), lambda s, x: join(s, own(x))))
    bases = F.aggregate(sums, F.array(F.lit(zero)), add)

    def within(starts: Column) -> Column:
        runs = F.transform(pieces, lambda b: F.aggregate(piece(b), F.array(F.element_at(starts, b + 1)), lambda acc, x: add(acc, own(x))))
        return F.flatten(F.transform(runs, lambda r: F.slice(r, F.lit(1), F.size(r) - 1)))

    return _let(bases, within)


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _all_matches(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of a rule: what lies between matches gives their places."""
    pattern = F.lit(rule.pattern)
    gaps, found = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    parts = F.arrays_zip(gaps.alias("gap"), found.alias("hit"), F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("own"))
    size = lambda f, x: F.coalesce(f(x), F.lit(0)).cast("int")
    sizes = F.transform(parts, lambda x: F.struct(*(size(f, x[c]).alias(n) for n, f, c in (("gap", F.length, "gap"), ("hit", F.length, "hit"), ("own", F.length, "own"), ("gap_b", F.octet_length, "gap"), ("hit_b", F.octet_length, "hit")))))

    def spans(xs: Column) -> Column:
        chars, raw = (_before(xs, lambda x, u=u: x[f"gap{u}"] + x[f"hit{u}"], _sum) for u in ("", "_b"))
        placed = F.arrays_zip(xs.alias("x"), chars.alias("c"), raw.alias("b"))
        kept = F.filter(placed, lambda p: (p["x"]["hit"] > 0) & (p["x"]["own"] >= rule.least))
        start, at = (lambda p: p["c"] + p["x"]["gap"]), (lambda p: p["b"] + p["x"]["gap_b"])
        return F.transform(kept, lambda p: F.struct(start(p).alias("start"), F.lit(rank).alias("rank"), (start(p) + p["x"]["hit"]).alias("end"), at(p).alias("at"), (at(p) + p["x"]["hit_b"]).alias("to")))

    return _let(sizes, spans)


def index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index for the trigrams that some rule asks for: a row (gram, doc_id) for each that a text holds."""
    text = F.lower("text")
    return docs.select("doc_id", F.explode(F.array_compact(F.array(*(F.when(F.contains(text, F.lit(g)), F.lit(g)) for g in trigrams)))).alias("gram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> tuple[DataFrame, list[int]]:
    """(doc_id, rules): rules as bits whose query a document's postings fulfil; and the rules without a query."""
    queries = [trigram_query(r.pattern) for r in rules]
    if any(len(grams) > 62 for q in queries for grams in q):
        raise ValueError("a clause of more than 62 trigrams")
    grams = sorted({g for q in queries for clause in q for g in clause})
    full = [i for i, q in enumerate(queries) if not q]
    clauses = [(i, j, g, 1 << n, (1 << len(c)) - 1) for i, q in enumerate(queries) for j, c in enumerate(q) for n, g in enumerate(sorted(c))]
    spark = docs.sparkSession
    asked = spark.createDataFrame(clauses, "rule int, clause int, gram string, bit long, need long")  # as many rows as the rules have trigrams
    if not clauses:
        return docs.select("doc_id", F.lit(0).cast("long").alias("rules")).where("false"), full
    met = index(docs, grams).join(F.broadcast(asked), "gram").groupBy("doc_id", "rule", "clause", "need").agg(F.bit_or("bit").alias("seen")).where("seen = need")
    return met.groupBy("doc_id").agg(F.bit_or(F.expr("shiftleft(1L, rule)")).alias("rules")), full


def scan(docs: DataFrame, rules: tuple[Rule, ...] = MORE) -> DataFrame:
    """key (the id), text, row (all columns of docs), base and found, for each row of docs.

    base and found are the sorted spans of the base rules and of all rules; the rank is a rule's place in BASE and then
    in `rules`. Rules with mandatory trigrams are tried on the documents that the index offers; `hex` has none and scans
    all. Only rows that a bitmap takes for offered ones are shuffled with their texts; the others are scanned where
    they are read. A null text is empty. Postings of rows that share an id are taken together: each row is verified by
    the patterns, so that a row more among the candidates changes nothing; rows without an id are joined as one id is.
    """
    every = (*BASE, *rules)
    offered, full = candidates(docs, every)
    offered = Scratch(docs.sparkSession, "secrets").keep(offered.select(F.col("doc_id").alias("offered_id"), F.col("rules").alias("offered_rules")), "offered")
    rest, asked = apart(docs, offered, "doc_id", "offered_id")
    met = asked.join(offered.hint("shuffle_hash"), F.col("key").eqNullSafe(F.col("offered_id")), "left").select("key", "row", "offered_rules")
    out = rest.withColumn("offered_rules", F.lit(None).cast("long")).unionAll(met).withColumn("text", F.coalesce(F.col("row.text"), F.lit("")))
    none = F.array().cast(SPAN)
    text, spans = F.col("text"), []
    for i, rule in enumerate(every):
        worth = text.rlike(rule.pattern)
        if i not in full:
            worth = F.coalesce(F.col("offered_rules").bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(False)) & worth
        spans.append(F.when(worth, _all_matches(text, rule, i)).otherwise(none))
    n = len(BASE)
    base, more = F.array_sort(F.concat(*spans[:n])), F.concat(*spans[n:]) if rules else none
    out = out.select("key", "text", "row", base.alias("base"), more.alias("more"))
    return out.select("key", "text", "row", "base", F.when(F.size("more") == 0, F.col("base")).otherwise(F.array_sort(F.concat("base", "more"))).alias("found"))


def _told(spans: Column, kinds: list[str]) -> Column:
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(spans: str, rank: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")


def secrets(docs: DataFrame, rules: tuple[Rule, ...] = MORE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of each row of docs."""
    kinds = [r.kind for r in (*BASE, *rules)]
    found = scan(docs.select("doc_id", "text"), rules)
    counts = [_count("base", i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)]
    return found.select(F.col("key").alias("doc_id"), *counts, F.sha2(_told(F.col("base"), kinds), 256).alias("base_sha256"), _told(F.col("found"), kinds).alias("spans"))


def op6_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows of docs, with each found span (overlapping ones as one) replaced by [SECRET], and n_chars told anew."""
    found = scan(docs)

    def clean(raw: Column) -> Column:
        """What stands before each span that begins after all earlier ones end, with the mark; and the rest."""
        reach = _before(F.col("found"), lambda s: s["to"], F.greatest)
        fresh = F.filter(F.arrays_zip(F.col("found").alias("s"), reach.alias("from")), lambda p: p["s"]["at"] >= p["from"])
        gaps = F.transform(fresh, lambda p: F.concat(F.substring(raw, p["from"] + 1, p["s"]["at"] - p["from"]).cast("string"), F.lit(MARK)))
        last = F.array_max(F.transform("found", lambda s: s["to"]))
        return F.concat(F.array_join(gaps, ""), F.substring(raw, last + 1, F.octet_length(raw)).cast("string"))

    some = F.size("found") > 0
    text = F.when(some, _let(F.col("text").cast("binary"), clean)).otherwise(F.col("row.text"))
    out = found.select("row", some.alias("some"), text.alias("text"))
    told = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        told["n_chars"] = F.when(F.col("some"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row")["n_chars"])
    return out.select(*(told.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
