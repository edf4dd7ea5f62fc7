"""run() against a plain version of each stage, over all documents of the smallest tables."""

from __future__ import annotations

import re
import zlib

import numpy as np
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from gridweave.llm import op2_decontamination as op2
from gridweave.llm import op6_secrets as op6
from gridweave.llm import op8_quality as op8
from gridweave.llm.encoders import vocabulary

DATA = "/root/testdata/sf0.001"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def first_of_groups(texts):
    fp = {k: fingerprint(t) for k, t in texts.items()}
    least = {k: k for k in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            m = min(least[b] for b in texts if bin(fp[a] ^ fp[b]).count("1") <= 2)
            changed, least[a] = changed or m < least[a], min(m, least[a])
    return {k: t for k, t in texts.items() if least[k] == k}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def contaminated(text, windows):
    words = words_of(text)
    hit = {j for n in {len(w) for w in windows} for i in range(len(words) - n + 1) if tuple(words[i : i + n]) in windows for j in range(i, i + n)}
    return len(hit) > 0 and 20 * len(hit) >= len(words)


RULES = [
    (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 8),
    (r"AKIA[A-Z0-9]+", 0, 0, 16),
    (r"[0-9a-f]+", 0, 0, 32),
    *((r.pattern, 0, 0, 1) for r in op6.MORE),
]


def redacted(text):
    spans = sorted(m.span() for p, flags, group, least in RULES for m in re.finditer(p, text or "", flags) if len(m[group]) >= least)
    out, at = "", 0
    for a, b in spans:
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:] if spans else text


def test_words_are_the_contract_s():
    text = "A-b\x00é1_z {x} \x7f\x80 don't 漢字\tÀB"
    assert [w.decode() for w in op2.words_of(text)] == words_of(text)


def test_run_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"] for r in op8.op8_subword_quality(spark, DATA).where("score >= 0.3").collect()}
    windows = set()
    for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect():
        w = words_of(r["text"])
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    want = first_of_groups({k: t for k, t in texts.items() if k in good})
    want = {k: redacted(t) for k, t in want.items() if not contaminated(t, windows)}
    assert 0 < len(want) < len(good) < len(texts)

    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, DATA)
        assert now.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in now.collect()} == want

    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    ids = {k: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for k, t in want.items()}
    rows = corpus_pipeline.run(spark, DATA).collect()
    places, covered = {}, dict.fromkeys(ids, 0)
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        assert r["start"] == covered[r["doc_id"]] and r["doc_tokens"] == len(ids[r["doc_id"]])
        covered[r["doc_id"]] += r["length"]
        assert zlib.crc32(ids[r["doc_id"]][r["start"] : covered[r["doc_id"]]].tobytes()) == r["ids_crc32"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert covered == {k: len(x) for k, x in ids.items()}
    for own in places.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 2048
