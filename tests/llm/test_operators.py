"""The training-data operators against brute force, round trips and held-out labels, and on odd tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

from gridweave.llm import op1_simhash as op1
from gridweave.llm import op2_decontamination as op2
from gridweave.llm import op3_packing as op3
from gridweave.llm import op4_token_files as op4
from gridweave.llm import op5_toxicity as op5
from gridweave.llm import op6_secrets as op6
from gridweave.llm import op7_embedding_join as op7
from gridweave.llm import op8_quality as op8
from gridweave.llm import op9_url_filter as op9
from gridweave.llm import op10_token_counts as op10
from gridweave.llm.common import Scratch, connected_components
from gridweave.llm.encoders import PartEncoder, vocabulary
from gridweave.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, _id string, rules int, part long, lang string, source string, n_chars long"
TEXTS = [
    None, "", " ", "\n\t", "one", "One two", "a b c", "a b c", "A  B\nC", "token = abcdefgh12 x", "password:secret:abcdefghijk", "AKIA" + "A1" * 8, "0123456789abcdef" * 3,
    "漢字 😀 token: 'aaaaaaaa'", "x" * 5000, "the cat sat on the mat. " * 400, "you are an idiot", "<|endoftext|> a", "\x1c \xa0 é", "one two three four five six seven eight nine ten eleven twelve thirteen fourteen",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1, 2, "en", "s", 0) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[4], rows[4], (None, "one", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)], SCHEMA)


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, edges):
    at = {n: n for n in nodes}
    while True:
        new = dict(at)
        for u, v in edges:
            new[u] = new[v] = min(new[u], new[v])
        if new == at:
            return at
        at = new


def test_components(spark):
    random.seed(1)
    edges = [(random.randrange(200), random.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(60)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "t")).collect()}
    want = roots({n for e in edges for n in e}, edges)
    assert found == {n: want[n] for u, v in edges if u != v for n in (u, v)}


def test_fingerprints_and_links(spark, docs):
    for t in TEXTS:
        assert op1.fingerprint(t) == brute_fingerprint(t)
    rows = op1.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    random.seed(2)
    base = [random.getrandbits(64) for _ in range(6)]
    fps = sorted({b ^ sum(1 << random.randrange(64) for _ in range(k)) for b in base for k in (0, 1, 2, 3) for _ in range(8)})
    signed = [int(np.uint64(f & (2**64 - 1)).astype(np.int64)) for f in fps]
    edges = [(r["u"], r["v"]) for r in op1.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()]
    pairs = [(a, b) for a, b in itertools.combinations(signed, 2) if bin((a ^ b) & (2**64 - 1)).count("1") <= 2]
    assert roots(signed, edges) == roots(signed, pairs)


def brute_hits(texts, items):
    windows = []
    for k, t in items:
        w = op2.words_of(t)
        windows += [(str(k), w[i : i + 13]) for i in range(max(1, len(w) - 12))] if w else []
    out = []
    for t in texts:
        d = op2.words_of(t)
        found = [(k, i, len(w)) for k, w in windows for i in range(len(d) - len(w) + 1) if d[i : i + len(w)] == w]
        out.append((len(d), len({j for _, i, n in found for j in range(i, i + n)}), sorted({k for k, _, _ in found})))
    return out


def test_wider_links_and_shingles(spark):
    rng, fps = random.Random(2), {0, (1 << 64) - 1}
    for _ in range(12):
        f = rng.getrandbits(64)
        for _ in range(4):
            fps.add(f)
            for b in rng.sample(range(64), rng.randint(1, 6)):
                f ^= 1 << b
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for radius in (0, 2, 4):
        top = {f: f for f in fps}

        def root(f, top=top):
            return f if top[f] == f else root(top[f])

        for u, v in itertools.combinations(sorted(fps), 2):
            if (u ^ v).bit_count() <= radius:
                top[root(u)] = root(v)
        want = {frozenset(f for f in fps if root(f) == r) for r in map(root, fps)}
        edges = [(r["u"] % (1 << 64), r["v"] % (1 << 64)) for r in op1.links(df, radius).collect()]
        assert all((u ^ v).bit_count() <= radius for u, v in edges)
        near = {f: {f} for f in fps}
        for u, v in edges:
            both = near[u] | near[v]
            for f in both:
                near[f] = both
        assert {frozenset(x) for x in near.values()} == want
    with pytest.raises(ValueError):
        op1.links(df, 3)
    text = "one two three four five six seven eight"
    got = op1.near_duplicates(spark.createDataFrame([(1, text)], "doc_id long, text string"), size=5).first()
    assert int(got["fingerprint"], 16) == op1.fingerprint(text, 5) != op1.fingerprint(text)


def test_fm_index_against_brute_force():
    random.seed(3)
    for _ in range(30):
        letters = ["a", "b", "c", "D", "é"][: random.randint(1, 5)]
        texts = [" ".join(random.choices(letters, k=random.choice([0, 3, 20, 60]))) for _ in range(15)] + [None, ""]
        texts += texts[:4]
        items = [(i, " ".join(random.choices(letters, k=random.choice([0, 1, 3, 13, 20])))) for i in range(4)] + [(99, texts[2]), (5, None)]
        blocks = [op2.Phrases([x for x in half if x[1]]) for half in (items[:2], items[2:])]
        got = [(n, int((s[:, 1] - s[:, 0]).sum()), x) for n, s, x in op2.find(texts, blocks, random.choice([1, 50, 10_000]), random.choice([1, 3, 8]))]
        assert got == brute_hits(texts, items)


def test_contamination(spark, docs):
    bench = spark.createDataFrame([(7, TEXTS[-1]), (8, None), (9, "one"), (10, "")], "item_id long, text string")
    rows = op2.contamination(docs, bench).collect()
    want = brute_hits([r["text"] for r in docs.collect()], [(7, TEXTS[-1]), (9, "one")])
    assert sorted((r["n_words"], r["n_hit"], r["items"], r["items_sha256"]) for r in rows) == sorted((n, h, x, hashlib.sha256(",".join(x).encode()).hexdigest()) for n, h, x in want)


@pytest.mark.parametrize(("name", "drops"), [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_parts_equal_whole_texts(name, drops):
    random.seed(4)
    some = ["a", "b", "the", " ", "  ", "\n", "\n\n", "'s", "É", "é", "é", ".", "!?", "12", "<|endoftext|>", "\t", "\xa0", "漢", "\x1c", "'", "Z", "İ", "\r\n", ","]
    texts = [t or "" for t in TEXTS] + ["".join(random.choices(some, k=random.randint(0, 12))) for _ in range(800)]
    coder = PartEncoder(vocabulary(name), drops, held=20_000)
    assert list(coder.encode(texts)) == [coder.whole(t) for t in texts]


def test_packing(spark, docs):
    rows = op3.packed(docs, with_ids=True, group=8).collect()
    coder = PartEncoder(vocabulary("word_bpe_49k.json"), True)
    tokens = {r["doc_id"]: coder.whole(r["text"] or "") + b"\1\0\0\0" for r in docs.collect() if r["doc_id"] is not None}
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert zlib.crc32(r["ids"]) == r["ids_crc32"]
        if r["doc_id"] is not None:
            assert tokens[r["doc_id"]][4 * r["start"] : 4 * (r["start"] + r["length"])] == r["ids"]
    for own in by_seq.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    n = docs.count()
    assert sum(r["start"] == 0 for r in rows) == n


def test_best_fill_against_all_subsets():
    random.seed(5)
    for _ in range(200):
        lengths = [random.randint(1, 12) for _ in range(random.randint(0, 8))]
        counts = {x: lengths.count(x) for x in lengths}
        room = random.randint(0, 30)
        used = op3.best_fill(counts, room)
        assert all(k <= counts[x] for x, k in used.items())
        assert sum(x * k for x, k in used.items()) == max(s for k in range(len(lengths) + 1) for c in itertools.combinations(lengths, k) if (s := sum(c)) <= room)


def test_token_files_round_trip(spark, docs, tmp_path):
    scratch = Scratch(spark, "files")
    manifest = op4.write_token_files(docs, f"file://{tmp_path}", scratch)
    rows = sorted(op4.read_token_files(manifest, with_ids=True).collect(), key=lambda r: r["start"])
    coder = PartEncoder(vocabulary("byte_bpe_50k.json"), False)
    at, last = 0, -1
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        assert r["start"] == at and zlib.crc32(r["ids"]) == r["ids_crc32"]
        at += r["n_tokens"]
        if r["doc_id"] is not None:
            assert r["doc_id"] >= last and r["ids"] == coder.whole(texts[r["doc_id"]] or "") + b"\0\0\0\0"
            last = r["doc_id"]
    assert len(rows) == docs.count()
    assert {r["doc_id"] for r in op4.read_token_files(manifest, doc_ids=[3, 9]).collect()} == {3, 9}
    path = sorted(tmp_path.glob("*.zst"))[0]
    raw = bytearray(path.read_bytes())
    raw[6] ^= 255
    path.write_bytes(raw)
    with op4.open_uri(f"file://{path}")[2] as file, pytest.raises(Exception):  # noqa: B017
        reader = op4.Reader(file)
        for doc in reader.docs:
            list(reader.frames(doc))


CONTRACT = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 8), ("access", r"AKIA[A-Z0-9]+", 0, 0, 16), ("hex", r"[0-9a-f]+", 0, 0, 32)]


def test_secrets_against_python(spark, docs):
    want = {}
    for r in docs.collect():
        spans = sorted((m.start(), k, name, m.end()) for k, (name, p, flags, group, least) in enumerate(CONTRACT) for m in re.finditer(p, r["text"] or "", flags) if len(m[group]) >= least)
        want[r["doc_id"]] = ",".join(f"{name}:{a}:{b}" for a, _, name, b in spans)
    for r in op6.secrets(docs).collect():
        if r["doc_id"] is not None:
            assert [r["n_assign"], r["n_access"], r["n_hex"]] == [want[r["doc_id"]].count(f"{k}:") for k, *_ in CONTRACT]
            assert r["base_sha256"] == hashlib.sha256(want[r["doc_id"]].encode()).hexdigest()
            assert r["spans"] == want[r["doc_id"]]
    clean = {r["doc_id"]: r for r in op6.redact(spark, docs, DATA).collect()}
    assert clean[9]["text"] == "[SECRET] x" and clean[9]["n_chars"] == 10 and clean[4]["text"] == "one"
    assert op6.trigram_query("[0-9a-f]{32,}") == []
    assert frozenset({"aki", "kia"}) in op6.trigram_query("AKIA[A-Z0-9]{12,}")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_agree_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    cur = con.execute(ORACLE_SQL[name])
    df = QUERIES[name](spark, DATA)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(cur.fetchall())


def test_many_secrets(spark):
    """Very many matches in one text, of kinds that overlap, with letters of several bytes between them."""
    rng = random.Random(9)
    some = ["token=abcdefgh12", "password: é secret=00ffaa0011223344", "AKIA" + "B2" * 9, "0123456789abcdef" * 2, "ü 漢 😀", "api_key='" + "0af3" * 9 + "'", "x\n"]
    texts = [" ".join(rng.choices(some, k=k)) for k in (0, 1, 5, 127, 128, 129, 900)] + ["token=abcdefgh " * 12_000]
    df = spark.createDataFrame([(i, t, len(t), "r") for i, t in enumerate(texts)], "doc_id long, text string, n_chars int, row string")
    clean = {r["doc_id"]: r for r in op6.redact(spark, df, DATA).collect()}
    for r in op6.secrets(df, ()).collect():
        text = texts[r["doc_id"]]
        spans = sorted((m.start(), k, name, m.end()) for k, (name, p, flags, group, least) in enumerate(CONTRACT) for m in re.finditer(p, text, flags) if len(m[group]) >= least)
        assert r["spans"] == ",".join(f"{name}:{a}:{b}" for a, _, name, b in spans)
        out, at = "", 0
        for a, _, _, b in spans:
            out += text[at:a] + "[SECRET]" if a >= at else ""
            at = max(at, b)
        assert (clean[r["doc_id"]]["text"], clean[r["doc_id"]]["row"]) == (out + text[at:], "r")


def test_repeated_vector_ids(spark):
    df = spark.createDataFrame([(5, [1.0, 0.0], "a"), (5, [0.0, 1.0], "b"), (6, [1.0, 0.01], "c"), (5, [1.0, 0.0], "d"), (7, None, "e")], "vec_id long, embedding array<double>, key string")
    rows = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in op7.linked(df).collect())
    assert rows == [(5, 0, 5, True), (5, 2, 5, True), (5, 2, 5, True), (6, 2, 5, False), (7, 0, 7, True)]


def test_embedding_links(spark):
    draw = np.random.default_rng(6)
    base = draw.normal(size=(12, 8))
    vecs = [(base[i % 12] + draw.normal(size=8) * 0.12).tolist() for i in range(150)] + [[1.0] * 8] * 9 + [[0.0] * 8, None, [1.0, None], [float("nan")] * 8, [3.0, 4.0], [6.0, 8.0], [1e300] * 8]
    rows = [(i, v, 0) for i, v in enumerate(vecs)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    edges = []
    for (i, a, _), (j, b, _) in itertools.combinations(rows, 2):
        if a and b and None not in a and None not in b and len(a) == len(b) and np.isfinite(a).all() and np.isfinite(b).all() and any(a) and any(b):
            x, y = np.array(a) / np.abs(a).max(), np.array(b) / np.abs(b).max()
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9:
                edges.append((i, j))
    want = roots(range(len(rows)), edges)
    for block in (4096, 16):
        for r in op7.linked(df, block=block).collect():
            assert r["component_id"] == want[r["vec_id"]] and r["n_links"] == sum(r["vec_id"] in e for e in edges) and r["kept"] == (r["vec_id"] == r["component_id"])


def test_held_out_accuracy(spark):
    from measures import accuracy

    data = "/root/testdata/sf0.01"
    docs_, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    assert accuracy(op8.quality_scores(docs_, labels), labels, "quality") > 0.95
    assert accuracy(op5.toxicity(docs_, labels), labels, "toxic") > 0.9


def test_grammar_scores_clauses():
    g = op5.Grammar({"idiot$": 3.0, "lowei": 3.0}, op5.PRIOR)
    bare, targeted, negated, reported = (g.score(t) for t in ("what an idiot", "you are an idiot", "not an idiot", "she said idiot"))
    assert targeted > bare > negated and bare > reported and g.score("you loweix") > 0.3 > g.score("nothing here") == g.score(None)
    assert g.score("idiot") == g.score("idiot. idiot\nidiot!") == g.score("")  # words alone are no clauses
    kind = lambda t: np.flatnonzero(g.matches(t)).tolist()
    assert kind("They were all idiots, you know") == [op5.TARGETED] and kind("The idiots of the town") == [op5.BARE]
    for t in ("she said: you are an idiot", "he says that you are an idiot", "you are an idiot, they wrote", "Sie sagte: du idiot", "il disait: tu idiot", "a quoted idiot of old"):
        assert kind(t) == [op5.REPORTED]
    assert kind("she said hello. you are an idiot") == [op5.TARGETED]
    for t in ("they are killing you", "i will kill you", "he burned them", "wir töten dich", "ils frappent vous"):
        assert kind(t) == [op5.THREATENED]
    assert kind("to kill time") == kind("you kill time") == []
    for t in ("you are not an idiot", "du bist kein idiot", "never any idiots here"):
        assert kind(t) == [op5.NEGATED]
    assert kind("not an idiot but you idiot") == [op5.TARGETED]
    assert g.matches("an idiot and an idiot; you idiot").tolist() == [3.0, 3.0, 0, 0, 0]


def brute_kind(classes):
    """The kind of one clause by its rules, without states; classes: those of its words."""
    n, hot = len(classes), [i for i, c in enumerate(classes) if c in (op5.INSULT, op5.THREAT)]
    at = lambda c: [i for i, x in enumerate(classes) if x == c]
    insult, target, deny = at(op5.INSULT), at(op5.TARGET), at(op5.NEGATION)
    threat = any(0 < t - i <= 3 and op5.THREAT not in classes[i + 1 : t] for i in at(op5.THREAT) for t in target)
    if n < 2 or not (insult or threat):
        return -1, bool(at(op5.REPORT))
    if at(op5.REPORT):
        return op5.REPORTED, True
    if all(any(0 < i - d <= 3 for d in deny) for i in hot):
        return op5.NEGATED, False
    return op5.THREATENED if threat else op5.TARGETED if any(0 < abs(i - t) <= 4 for i in insult for t in target) else op5.BARE, False


def test_automaton_against_rules():
    """The composed automaton says of random clauses what the rules and the separate transducers say."""
    rng, (after, says) = random.Random(8), op5.automaton()
    seen = set()
    for _ in range(6000):
        state, parts, said = 0, [p.start for p in op5.PARTS], False
        for _ in range(rng.randint(1, 3)):
            clause = rng.choices(range(6), [5, 2, 1, 2, 1, 0.5], k=rng.randint(0, 9))
            for c in clause:
                assert says[state][c] == -1
                state, parts = after[state][c], [p.step(s, c)[0] for p, s in zip(op5.PARTS, parts, strict=True)]
            end = rng.choice([op5.COLON, op5.END])
            want, report = brute_kind(clause)
            if said and want >= 0:
                want = op5.REPORTED
            assert says[state][end] == op5.kind_of({x for p, s in zip(op5.PARTS, parts, strict=True) for x in p.step(s, end)[1]}) == want
            state, parts = after[state][end], [p.step(s, end)[0] for p, s in zip(op5.PARTS, parts, strict=True)]
            said = end == op5.COLON and (said or report)
            seen.add(want)
    assert seen == {-1, op5.BARE, op5.TARGETED, op5.NEGATED, op5.REPORTED, op5.THREATENED}


def test_urls(spark):
    urls = ["http://A.Example.NET/en/1?x", "https://b.net", "https://b.net/x", "ftp://example.com/de/1", "http://xorg/fr/1", "http://x.org/fr/1#t", None, "no scheme", "://", "http://x.org/en/a/b/c/d/e"]
    df = spark.createDataFrame([(i, u, "h", "t") for i, u in enumerate(urls)], "page_id long, url string, host string, template string")
    found = {r["page_id"]: r for r in op9.filtered(df).collect()}
    assert [found[i]["rule"] for i in range(10)] == ["example.net/en/", None, "net/", "example.com/de/", None, "org/fr/", None, None, None, None]
    assert (found[0]["host"], found[0]["path"], found[0]["verdict"], found[2]["verdict"]) == ("a.example.net", "/en/1", "allow", "block")
    assert (found[6]["host"], found[6]["path"]) == ("", "") and len(found) == len(urls)


def pages_of(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def test_url_templates(spark):
    """The path decides: on a host without labels, only what is blocked elsewhere is blocked."""
    net = [f"http://a{h}.net/{p}/{i}" for h in range(3) for i in range(20) for p in ("x", "y")]
    en = [f"http://b.example.net/en/{i}" for i in range(60)]
    wide = [f"http://w.com/{chr(97 + i) * 3}/{i}" for i in range(op9.VALUES + 1)]
    urls = [*net, *en, *wide, "http://c.com/x/7", "http://c.com//y/8", "http://c.com/en/9", "http://c.com/z/1"]
    found = {urls[r["page_id"]]: r for r in op9.filtered(pages_of(spark, urls)).collect()}
    start = {u: r["template"].split("/")[1] for u, r in found.items()}
    assert all(start[u] == "*" for u in wide) and all(start[u] == u.split("/")[3] for u in net)
    ends = [found[u] for u in urls[-4:]]
    assert [r["verdict"] for r in ends] == ["block", "block", "allow", "allow"]
    assert ends[2]["purity"] < 0.1 and ends[3]["purity"] == 0.5


def brute_templates(rows, d=0, at=()):
    """{path: nodes} of one host's tree; rows: {path: pages}, paths as tuples of segments."""
    out, kids = {p: at for p in rows if len(p) == d}, {}
    for p in rows:
        if len(p) > d:
            kids.setdefault(p[d], {})[p] = rows[p]
    pages = sum(sum(k.values()) for k in kids.values())
    if len(kids) > op9.VALUES and pages < op9.PAGES_PER_VALUE * len(kids):
        kids = {"*": {p: n for k in kids.values() for p, n in k.items()}}
    for name, k in kids.items():
        out |= brute_templates(k, d + 1, (*at, name))
    return out


def test_deep_urls(spark):
    """Every level counts: the fourth segment divides what is blocked, and wildcards are found at any depth."""
    urls = [f"http://a{i % 3}.net/fr/x/y/ads/{i}" for i in range(60)] + [f"http://b{i % 3}.org/fr/x/y/news/{i}" for i in range(60)]
    got = {r["page_id"]: r for r in op9.filtered(pages_of(spark, [*urls, "http://c.com/fr/x/y/ads/2", "http://c.com/fr/x/y/news/2"])).collect()}
    assert (got[120]["verdict"], got[121]["verdict"]) == ("block", "allow")

    rng = random.Random(5)
    paths = [tuple(rng.choice("ab" if k != 3 else "abcdefghijklmnopqrst") for k in range(rng.randint(1, 7))) for _ in range(500)] + [tuple("abcabcabcabc")]
    got = {r["path"]: r["template"] for r in op9.filtered(pages_of(spark, ["http://c.com/" + "/".join(p) + rng.choice(["", "/"]) for p in paths])).collect()}
    want = brute_templates({p: paths.count(p) for p in paths})
    assert {tuple(p.strip("/").split("/")): t for p, t in got.items()} == {p: "/" + "/".join(t) for p, t in want.items()}
    assert any("*" in t for t in want.values())


def brute_groups(items):
    """Groups of the leaves of one host, by recursion; items: [(rest of the nodes, leaf)], leaf: (b, l, ob, ol, name)."""
    done = []

    def differ(b, n, b2, n2):
        p = (b + b2) / (n + n2) if n + n2 else 0
        return n > 0 and n2 > 0 and (b / n - b2 / n2) ** 2 > op9.ALIKE**2 * p * (1 - p) * (1 / n + 1 / n2)

    def evidence(leaves):
        b, n, ob, on = (sum(x[i] for x in leaves) for i in range(4))
        return (b, n) if n else (ob, on)

    def go(items):
        if items[0][0] == ():
            return [items[0][1]]
        below = {}
        for rest, leaf in items:
            below.setdefault(rest[0], []).append((rest[1:], leaf))
        subs = [go(v) for v in below.values()]
        kids = sorted(((-b / n, -n, b, n), x) for x in subs if x for b, n in [evidence(x)])
        total = [sum(k[0][i] for k in kids) for i in (2, 3)]
        groups, run = [[]], (0, 0)
        odd = any(differ(b, n, total[0] - b, total[1] - n) for (_, _, b, n), _ in kids)
        for (_, _, b, n), x in kids:
            if odd and differ(b, n, *run):
                groups, run = [*groups, []], (0, 0)
            groups[-1] += x
            run = (run[0] + b, run[1] + n)
        if len(groups) == 1 and all(subs):
            return groups[0]
        done.extend(g for g in groups if g)
        return None

    last = go([((*rest, "/"), leaf) for rest, leaf in items])
    return done + ([last] if last else [])


def test_url_branches(spark):
    """Small siblings are judged with those they don't differ from, and not with those they do, at every level."""
    net = [f"http://a.net/es/{i}" for i in range(60)] + [f"http://a.net/es/{i}.html" for i in range(11)] + [f"http://a.example.net/en/{i}" for i in range(40)]
    tops = [f"http://b.net/{p}/{i}" for p in ("p", "q", "r") for i in range(9)]
    urls = [*net, *tops, "http://c.com/es/1", "http://c.com/es/1.html", "http://c.com/en/1", "http://c.com/q/1", "http://c.com/z"]
    got = {urls[r["page_id"]]: r for r in op9.filtered(pages_of(spark, urls)).collect()}
    assert [got[u]["verdict"] for u in urls[-5:]] == ["block", "block", "allow", "block", "allow"]
    assert got["http://c.com/es/1"]["purity"] == got["http://c.com/es/1.html"]["purity"] == got["http://c.com/q/1"]["purity"]

    rng, leaves = random.Random(3), []
    for h in range(12):
        for at in {tuple(rng.choice("abcd") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 30))}:
            p, n = rng.choice([0, 0.5, 0.9, 1]) if h % 3 else 0.5, rng.choice([0, 1, 2, 10, 60])
            b = sum(rng.random() < p for _ in range(n))
            ol = rng.choice([0, 1, 8, 90]) if n else rng.choice([1, 8, 90])
            leaves.append((f"h{h}", list(at), b, n, rng.randint(0, ol), ol))
    df = spark.createDataFrame(leaves, "host string, nodes array<string>, b long, l long, ob long, ol long")
    found = {}
    for r in op9.merged(df, Scratch(spark, "branches")).collect():
        found.setdefault((r["host"], tuple(r["grp"])), set()).add(tuple(r["nodes"]))
    want = set()
    for h in {x[0] for x in leaves}:
        items = [(tuple(x[1]), (*x[2:], tuple(x[1]))) for x in leaves if x[0] == h]
        want |= {(h, frozenset(leaf[4] for leaf in g)) for g in brute_groups(items)}
    assert {(h, frozenset(v)) for (h, _), v in found.items()} == want
    assert 12 < len(want) < len(leaves)


def test_token_counts(spark, docs):
    whole = op10.Counter(vocabulary("piece_bpe_32k.model"))
    found = op10.token_counts(docs, chunk=64, overlap=8, limit=100).collect()
    for r, d in zip(found, docs.collect(), strict=True):
        assert r["n_tokens"] == whole.short([d["text"] or ""])[0] and r["n_bytes"] == len((d["text"] or "").encode())


def test_empty_tables(spark):
    docs_ = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for df in (op1.near_duplicates(docs_), op2.contamination(docs_, bench), op3.packed(docs_), op5.toxicity(docs_, labels), op6.secrets(docs_), op8.quality_scores(docs_, labels), op10.token_counts(docs_)):
        assert df.count() == 0
    scratch = Scratch(spark, "none")
    assert op4.read_token_files(op4.write_token_files(docs_, scratch.path("f"), scratch)).count() == 0
    assert op7.linked(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert op9.filtered(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_scores_on_odd_rows(spark, docs):
    labels = spark.createDataFrame([(1, None, 1), (None, 1, 0), (9, 0, 1), (9, 1, 0), (10, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    for df in (op8.quality_scores(docs, labels), op5.toxicity(docs, labels)):
        rows = df.collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_stages_keep_columns(spark, docs):
    one = op1.deduplicate(spark, docs, DATA)
    assert one.columns == docs.columns
    ids = [r["doc_id"] for r in one.collect() if r["doc_id"] is not None]
    assert len(ids) == len(set(ids)) and 6 in ids and 7 not in ids
    text = docs.where("doc_id = 4").first()["text"]
    odd = spark.createDataFrame([(4, "zzz zz z", "x"), (4, text, "y"), (4, text, "y"), (9, text, "y"), (None, text, "y")], "doc_id long, text string, odd_id string")
    assert sorted(map(str, op1.deduplicate(spark, odd, DATA).collect())) == sorted(map(str, [odd.collect()[1], odd.collect()[4]]))
    for stage in (op2.decontaminate, op8.keep_good, op6.redact):
        assert stage(spark, docs.limit(0), DATA).columns == docs.columns and stage(spark, docs.limit(0), DATA).count() == 0
    assert op1.deduplicate(spark, docs.limit(0), DATA).count() == 0
    for stage in (op2.decontaminate, op8.keep_good):
        assert stage(spark, docs, DATA).columns == docs.columns
