"""Toxicity scores from a weighted finite-state grammar of clauses."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .op8_quality import fold, sample_of

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, COLON, END = range(8)
#: Closed word classes in the four languages of the corpus; verbs by stem. Insults aren't listed: they are learned.
WORDS = {
    TARGET: "you your yours u he him his she her they them their du dich dir dein ihr euch euer sie ihn tu toi te vous votre il elle ils elles te usted ustedes vosotros ellos ellas tú".split(),
    NEGATION: "not no never neither nor without isn aren wasn don doesn didn cannot nicht kein keine keinen nie niemals ne pas jamais sans nunca jamás sin".split(),
}
STEMS = {
    THREAT: "kill hurt destroy burn shoot shot stab stabb beat crush töt umbring schlag tue frapp brûl matar golpe quem".split(),
    REPORT: "say said tell told call wrote write written quote quot claim report accord sagt sag schrieb schreib disai dit dis écri selon dij dice escrib según".split(),
}
#: Endings that a stem, or an insult learned as a whole word, may take.
ENDINGS = {"", "s", "es", "d", "ed", "n", "en", "ing", "ning", "t", "r", "z", "te", "st", "e", "er", "ez", "ent", "ons", "ait", "é", "ée", "o", "a", "as", "an", "ar", "aré", "ó", "ió", "ía"}
TOKEN = re.compile(r"[^\W_]+|[.!?;:\n]")
BARE, TARGETED, NEGATED, REPORTED, THREATENED = range(5)
#: Weights before any rows: of all direct clauses, what a target and a threat add, negated and reported ones, and the bias.
PRIOR = np.array([1.5, 0.5, 0.5, 0.1, 0.1, -2.5])
LOW, HIGH = np.array([0, 0.5, 0.5, -5, -5, -9.0]), np.array([9, 9, 9, 0.2, 0.2, 0])  # bounds of them
SAMPLE = 8000  # labelled documents that lexicon and weights are fitted on, in the order of a hash
CUT = 0.3
STEM = range(3, 13)
KNOWN = 300_000  # words whose class a task remembers
LEAST, MOST = 0.5, 3.0  # bounds of an insult's weight, half its log odds
SURE = 2.0  # the weight at which a clause begins to tell
WITHOUT = 2.5  # the weight of a clause without an insult: of a threat


@dataclass
class Transducer:
    """Deterministic: arcs lead from (state, class) to (state, what it says); where there is none, the state stays."""

    arcs: dict[tuple, tuple]
    start: object = 0

    def step(self, state: object, kind: int) -> tuple:
        return self.arcs.get((state, kind), (state, ()))


def _built(start: object, move, name: str, colon_ends: bool = True) -> Transducer:
    """The transducer of a rule: move(state, class) is the next state within a clause, or a name to say and a state.

    It is unrolled into arcs over the states that can be reached. At the end of a clause a state whose last entry is True
    says the name; a colon is such an end too, unless the rule says what it does there.
    """
    arcs, todo, seen = {}, [start], {start}
    for state in todo:
        for kind in range(8):
            over = kind == END or (kind == COLON and colon_ends)
            to = start if over else move(state, kind)
            arcs[state, kind] = (to, (name,) if kind in (END, COLON) and state[-1] else ())
            if to not in seen:
                seen.add(to)
                todo.append(to)
    return Transducer(arcs, start)


def _clause(state: tuple, kind: int) -> tuple:
    """(words, whether two or more)."""
    n = min(2, state[0] + 1)
    return (n, n == 2)


def _insult(state: tuple, kind: int) -> tuple:
    return (state[0] or kind == INSULT,)


def _target(state: tuple, kind: int) -> tuple:
    """(words for which a target reaches on, the same for an insult, met): either may come first."""
    t, i, met = state
    met = met or (kind == INSULT and t > 0) or (kind == TARGET and i > 0)
    return (4 if kind == TARGET else max(0, t - 1), 4 if kind == INSULT else max(0, i - 1), met)


def _threat(state: tuple, kind: int) -> tuple:
    """(words for which a threat reaches on, met): a verb and then its target."""
    t, met = state
    return (3 if kind == THREAT else max(0, t - 1), met or (kind == TARGET and t > 0))


def _negation(state: tuple, kind: int) -> tuple:
    """(words for which a negation reaches on, some insult or threat isn't negated, one is and none isn't)."""
    n, plain, met = state
    if kind in (INSULT, THREAT):
        plain = plain or not n
        met = not plain
    return (3 if kind == NEGATION else max(0, n - 1), plain, met)


def _report(state: tuple, kind: int) -> tuple:
    """(a report word stood, an insult or threat stood, both); a colon keeps the former for what is quoted after it."""
    said, some, _ = state
    if kind == COLON:
        return (said, False, False)
    said, some = said or kind == REPORT, some or kind in (INSULT, THREAT)
    return (said, some, said and some)


CLAUSES, INSULTS = _built((0, False), _clause, "words"), _built((False,), _insult, "insult")
TARGETS, THREATS = _built((0, 0, False), _target, "targeted"), _built((0, False), _threat, "threat")
NEGATIONS, REPORTS = _built((0, False, False), _negation, "negated"), _built((False, False, False), _report, "reported", colon_ends=False)
PARTS = [CLAUSES, INSULTS, TARGETS, THREATS, NEGATIONS, REPORTS]


def kind_of(said: set[str]) -> int:
    """The kind of a clause by what the transducers say at its end; -1: none. A word alone is no clause."""
    if "words" not in said or not said & {"insult", "threat"}:
        return -1
    return REPORTED if "reported" in said else NEGATED if "negated" in said else THREATENED if "threat" in said else TARGETED if "targeted" in said else BARE


def compose(parts: list[Transducer]) -> tuple[list[list[int]], list[list[int]]]:
    """The product automaton as tables: next state, and the clause kind that an arc matches (-1: none), by state and class."""
    numbers = {(start := tuple(p.start for p in parts)): 0}
    todo, after, says = [start], [], []
    for state in todo:
        row, out = [], []
        for c in range(8):
            steps = [p.step(s, c) for p, s in zip(parts, state, strict=True)]
            to = tuple(s for s, _ in steps)
            if to not in numbers:
                numbers[to] = len(numbers)
                todo.append(to)
            row.append(numbers[to])
            out.append(kind_of({x for _, xs in steps for x in xs}))
        after.append(row)
        says.append(out)
    return after, says


_TABLES: list = []  # the product automaton, made once in a process


def automaton() -> tuple[list[list[int]], list[list[int]]]:
    if not _TABLES:
        _TABLES.append(compose(PARTS))
    return _TABLES[0]


@dataclass
class Grammar:
    """Insults (whole words end in $, others are stems) with their weights, and the weights of matched clauses."""

    lexicon: dict[str, float]
    weights: np.ndarray
    known: dict[str, tuple[int, float]] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.after, self.says = automaton()
        self.closed = {w: c for c, words in WORDS.items() for w in words}
        self.closed |= {stem + e: c for c, stems in STEMS.items() for stem in stems for e in ENDINGS if stem + e not in self.closed}

    def classify(self, word: str) -> tuple[int, float]:
        if word in ".!?;\n":
            return END, 0.0
        if word == ":":
            return COLON, 0.0
        ways = [*keys(word), *(f"{word[: -len(e)]}$" for e in ENDINGS if e and word.endswith(e))]
        found = max((self.lexicon.get(k, 0.0) for k in ways), default=0.0)
        return (INSULT, found) if found else (self.closed.get(word, OTHER), 0.0)

    def matches(self, text: str | None) -> np.ndarray:
        """For each clause kind the summed weight of its clauses in the whole text: the greatest of an insult in it, or WITHOUT."""
        out = np.zeros(5)
        words = TOKEN.findall((text or "").lower())
        if len(self.known) > KNOWN:
            self.known.clear()
        own = set(words)
        for w in own.difference(self.known):
            self.known[w] = self.classify(w)
        known = self.known
        if not any(known[w][0] in (INSULT, THREAT) for w in own):
            return out
        state, top, after, says = 0, 0.0, self.after, self.says
        for w in words:
            c, weight = known[w]
            if weight > top:
                top = weight
            if c >= COLON:
                kind = says[state][c]
                if kind >= 0:
                    out[kind] += top or WITHOUT
                top = 0.0
            state = after[state][c]
        kind = says[state][END]
        if kind >= 0:
            out[kind] += top or WITHOUT
        return out

    def features(self, text: str | None) -> np.ndarray:
        """Of summed weights x the logarithm of 1 + (x / SURE)^4, so that one weak clause tells little; there's no cap."""
        m = self.matches(text)
        x = [m[BARE] + m[TARGETED] + m[THREATENED], m[TARGETED], m[THREATENED], m[NEGATED], m[REPORTED]]
        return np.append(np.log1p((np.array(x) / SURE) ** 4), 1.0)

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(text) @ self.weights, -30, 30))))


def keys(word: str) -> list[str]:
    """The whole word and its stems."""
    return [f"{word}$", *(word[:n] for n in STEM if n <= len(word))]


def learn_lexicon(rows: list[tuple[int, str]]) -> dict[str, float]:
    """Words and stems that stand in toxic documents only too often for chance, with a weight by how surely.

    Support is the number of toxic documents, but no more than of different neighbourhoods, so copies of one document
    don't make a word of it an insult. A key needs support beyond what chance gives any of all keys (Bonferroni), and
    four of five documents with it toxic. Of nested keys with nearly the same support the longest stays.
    """
    base = (sum(y for y, _ in rows) + 0.5) / (len(rows) + 1)
    docs: Counter = Counter()
    for y, text in rows:
        if y:
            docs.update({k for w in set(TOKEN.findall(text.lower())) if w[0].isalpha() for k in keys(w)})
    least = (math.log(max(1, len(docs))) + 2) / -math.log(base)
    often = {k for k, n in docs.items() if n >= least}
    clean: Counter = Counter()
    for y, text in rows:
        if not y:
            clean.update({k for w in set(TOKEN.findall(text.lower())) for k in keys(w) if k in often})
    often = {k for k in often if docs[k] >= 4 * clean[k]}
    around: dict[str, set[int]] = defaultdict(set)
    for y, text in rows:
        if y:
            words = ["", *TOKEN.findall(text.lower()), ""]
            for a, w, b in zip(words, words[1:], words[2:], strict=False):
                for k in keys(w):
                    if k in often:
                        around[k].add(zlib.crc32(f"{a} {b}".encode()))
    support = {k: min(docs[k], len(around[k])) for k in often}
    good = {k: n for k, n in support.items() if n >= max(least, 4 * clean[k])}
    longer: dict[str, int] = defaultdict(int)  # the most support of a key that is one step longer
    for k, n in good.items():
        shorter = k[:-1]
        longer[shorter] = max(longer[shorter], n)
    chosen: dict[str, float] = {}
    for k in sorted(good, key=lambda k: (len(k), k)):
        if longer[k] < 0.95 * good[k] and not any(s in chosen for s in keys(k.rstrip("$")) if s != k):
            odds = (good[k] + 0.5) / (clean[k] + 0.5)
            chosen[k] = min(MOST, max(LEAST, math.log(odds / (base / (1 - base))) / 2))
    return chosen


def learn_weights(grammar: Grammar, rows: list[tuple[int, str]], rounds: int = 1200, rate: float = 0.25) -> np.ndarray:
    """Logistic regression on matched clauses by gradient descent within LOW and HIGH, drawn towards PRIOR as by one document.

    Within the bounds a clause with a target, or a threat, never counts less than one without.
    """
    if not rows:
        return PRIOR.copy()
    x, y = np.array([grammar.features(t) for _, t in rows]), np.array([y for y, _ in rows], float)
    w = PRIOR.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = np.clip(w - rate * (x.T @ (p - y) + 0.5 * (w - PRIOR)) / len(y) * 4, LOW, HIGH)
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str, learnable: F.Column, n: int = SAMPLE) -> Grammar:
    """Fits the lexicon and the weights on a bounded sample of whole labelled documents; without any, PRIOR stands."""
    rows = [(int(r["y"] > 0), r["text"] or "") for r in sorted(sample_of(docs, labels, label, learnable, n).collect(), key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["text"] or ""))]
    lexicon = learn_lexicon(rows) if any(y for y, _ in rows) and not all(y for y, _ in rows) else {}
    grammar = Grammar(lexicon, PRIOR)
    return Grammar(lexicon, learn_weights(grammar, rows))


def toxicity(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs; null and empty texts match nothing.

    A score hangs on the text alone: repeated rows score alike, and rows without an id are scored, and never held out.
    """
    grammar = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, "toxic", ~fold(4, 2)))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Grammar(grammar.value.lexicon, grammar.value.weights)
        for batch in batches:
            scores = np.array([own.score(t.as_py()) for t in batch.column(2)], np.float64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= cut).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", fold(4, 2).alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def op5_clause_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
