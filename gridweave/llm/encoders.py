"""Whole-text token ids from the public tokenizer files, by parts that are encoded once and remembered."""

from __future__ import annotations

import os
import re
from codecs import charmap_decode
from collections.abc import Iterable, Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import released

#: Characters that stand for themselves in every normaliser used here, and aren't white space.
PLAIN = "!-~¡-įı-ſ"
MARKS = ",."
HELD = 160 << 20  # bytes of remembered parts, by estimate
BLOCK = 1 << 23  # characters of text that are cut, and whose distinct parts are looked up, at once
LEAN = 96 << 20, 1 << 21  # the same where a worker has less memory
TAKEN = 1 << 18  # parts whose ids are gathered at once


def vocabulary(name: str) -> str:
    """The place of a public tokenizer file; each executor has the files."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PartEncoder:
    """Ids of the tokenizers library for whole texts, without the cost of encoding a frequent part again and again.

    Both tokenizers split a text into words before they merge, so ids of a text are the ids of its parts if it is cut
    only where the splitting rule must cut. `drops_space` tells the two rules apart:

    * True: letters, digits and marks are words and white space is dropped; any plain white space is a cut, and lower
      and upper case are one.
    * False: a word takes the one space before it; a text is cut before a space and around a line break, if both sides
      are plain characters.

    A text with anything else (other scripts, other white space, runs of it, or the start of a special string) is
    given to the library whole. The tests hold both ways against the library. Texts are cut and their distinct parts
    found by Arrow; the ids of all known parts lie in one array. Ids are `width` bytes wide.
    """

    def __init__(self, path: str, drops_space: bool, held: int = HELD, width: int = 4, block: int = BLOCK):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.library = Tokenizer.from_file(path)
        if self.library.get_vocab_size() > 1 << 8 * width:
            raise ValueError(f"the vocabulary doesn't fit {width} bytes")
        self.drops_space, self.kind = drops_space, np.dtype(f"<u{width}")
        self.odd = re.compile(rf"[^\t\n\r {PLAIN}]|<\|" if drops_space else rf"[^\n{PLAIN}]|<\||^\n?$").search
        special = [(i, t.content) for i, t in self.library.get_added_tokens_decoder().items()]
        self.cut_id, self.cut = max(special) if drops_space else (int(self._ids("\n")[0]), "\n")  # a line break is one id
        self.marks = {m: int(self._ids(m)[0]) for m in MARKS}
        self._letters_only()
        self.limit, self.block = held, block
        self.full: tuple[int, int, int] | None = None  # parts, ids and bytes held when the limit was reached
        self.young: list[str] = []  # parts learned since then
        self.held = 0
        self.known: dict[str, int] = {}
        self.n = self.used = 0
        self.start, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int32)  # where the ids of a part lie
        self.ids = np.zeros(8192, self.kind)

    def whole(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def _ids(self, text: str) -> np.ndarray:
        """The library's ids; its fast call leaves out the places of tokens, which aren't needed."""
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _put(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Remembers the ids of new parts, which lie one after the other in ids."""
        n, used = self.n + len(keys), self.used + len(ids)
        while n > len(self.start):
            self.start, self.size = (np.concatenate((x, np.zeros(len(x) // 2, x.dtype))) for x in (self.start, self.size))
        while used > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(len(self.ids) // 2, self.kind)))
        self.ids[self.used : used] = ids
        self.size[self.n : n] = sizes
        self.start[self.n : n] = self.used + np.cumsum(sizes) - sizes
        self.known.update(zip(keys, range(self.n, n), strict=True))
        if self.full:
            self.young += keys
        self.held += 180 * len(keys) + sum(map(len, keys)) + ids.nbytes
        self.n, self.used = n, used

    def _taken(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of the parts at these places, one after the other."""
        sizes = self.size[places]
        ends = np.cumsum(sizes, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.start[places] - ends + sizes, sizes) + np.arange(total)], sizes

    def _apart(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Parts are encoded together: the library cuts at a special string before all else, and at a line break as in any text."""
        ids = self._ids(self.cut.join(parts))
        cut = ids == self.cut_id
        ends = np.append(np.flatnonzero(cut), len(ids))
        return ids[~cut], np.diff(ends, prepend=-1) - 1

    def _letters_only(self) -> None:
        """For words of letters, which the library's model is given in its own alphabet, a blank between them.

        Such a word (with its space, if it keeps one) is one piece of the splitting rule, so nothing is left to split or to
        normalise. Where a word's ids end is told by the space, which only its first token holds, or by the suffix of
        its last token.
        """
        from tokenizers import pre_tokenizers

        self.rule, self.blanks = (self.library.normalizer, self.library.pre_tokenizer), pre_tokenizers.WhitespaceSplit()
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]  # bytes that stand for themselves
        hidden = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in shown)}
        self.alphabet = "".join(chr(hidden.get(b, b)) if b != 10 else "\n" for b in range(256))
        space = self.alphabet[32]
        self.edge = np.zeros(self.library.get_vocab_size(), bool)
        self.edge[[i for w, i in self.library.get_vocab().items() if (w.endswith("</w>") if self.drops_space else w.startswith(space))]] = True

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of words of letters, one after the other."""
        line = "\n".join(words if self.drops_space else [f" {w}" for w in words])
        self.library.normalizer, self.library.pre_tokenizer = None, self.blanks
        try:
            ids = self._ids(charmap_decode(line.encode(), "strict", self.alphabet)[0])
        finally:
            self.library.normalizer, self.library.pre_tokenizer = self.rule
        edges = np.flatnonzero(self.edge[ids])
        return ids, np.diff(edges, prepend=-1) if self.drops_space else np.diff(np.append(edges, len(ids)))

    def _learn(self, new: list[str]) -> None:
        """Encodes parts that aren't known.

        A key is a part, but if space isn't dropped, a key that begins with a line break is that and the word after it,
        and any other key a word with a space. A comma or full stop after a letter is a word of its own by either rule,
        so such a part is put together from its word and the mark.
        """
        marked = [k for k in new if k[-1:] in MARKS and k[-2:-1].isalpha()]
        if marked:
            own = set(new).difference(marked)
            own.update(k for k in (k[:-1] for k in marked) if k not in self.known)
            new = list(own)
        words = [k for k in new if k.isalpha()]
        new = [k for k in new if not k.isalpha()]
        for at in range(0, len(words), 2000):
            some = words[at : at + 2000]
            self._put(some, *self._words(some))
        for at in range(0, len(new), 2000):
            some = new[at : at + 2000]
            if self.drops_space:
                self._put(some, *self._apart(some))
                continue
            first = np.array([k[0] == "\n" for k in some])
            ids, sizes = self._apart([k[1:] if k[0] == "\n" else f" {k}" for k in some])
            ids = np.insert(ids, (np.cumsum(sizes) - sizes)[first], self.cut_id)
            self._put(some, ids, sizes + first)
        if marked:
            ids, sizes = self._taken(np.array([self.known[k[:-1]] for k in marked]))
            self._put(marked, np.insert(ids, np.cumsum(sizes), [self.marks[k[-1]] for k in marked]), sizes + 1)

    def _places(self, keys: list[str]) -> np.ndarray:
        """The place of each key, -1 for those that the library must see within their text."""
        if self.full is None and self.held > self.limit:
            self.full = (self.n, self.used, self.held)
        if self.full and self.held > self.limit + self.limit // 4:  # what came first is the most frequent and stays, later parts come and go
            self.n, self.used, self.held = self.full
            for k in self.young:
                del self.known[k]
            self.young.clear()
        at = np.fromiter(map(self.known.get, keys, repeat(-1)), np.int64, len(keys))
        todo = np.flatnonzero(at < 0).tolist()
        new = [keys[i] for i in todo]
        if not self.drops_space:
            plain = [not odd for odd in map(self.odd, new)]
            todo, new = list(compress(todo, plain)), list(compress(new, plain))
        if new:
            self._learn(new)
            at[todo] = [self.known[k] for k in new]
        return at

    def _few(self, texts: list[str]) -> list[bytes]:
        if self.drops_space:
            plain = [not self.odd(t) for t in texts]
            cut = pc.ascii_split_whitespace(pa.array([t.lower() for t in compress(texts, plain)], pa.large_string()))
        else:  # a part for each space, and one with a line break before it for each line; so the text has one too many
            plain = [True] * len(texts)
            cut = pc.split_pattern(pa.array(["\n" + t.replace("\n", " \n") for t in texts], pa.large_string()), " ")
        parts = cut.flatten().dictionary_encode()
        at = self._places(parts.dictionary.to_pylist())[parts.indices.to_numpy()]
        bad = at < 0
        edges = cut.offsets.to_numpy()
        odd = np.diff(np.concatenate(([0], np.cumsum(bad)))[edges]).tolist()
        at[bad] = 0
        ends = np.concatenate(([0], np.cumsum(self.size[at], dtype=np.int64)))[edges].tolist()
        raw = b"".join(self._taken(at[i : i + TAKEN])[0].tobytes() for i in range(0, len(at), TAKEN))
        skip, out, k = 0 if self.drops_space else 1, [], 0
        wide = self.kind.itemsize
        for t, known in zip(texts, plain, strict=True):
            out.append(raw[(ends[k] + skip) * wide : ends[k + 1] * wide] if known and not odd[k] else self.whole(t))
            k += known
        return out

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each whole text, as little-endian unsigned integers of `width` bytes; null is empty."""
        some: list[str] = []
        size = 0
        for t in texts:
            some.append(t or "")
            size += len(some[-1])
            if size >= self.block:
                yield from self._few(some)
                some, size = [], 0
                if self.block < BLOCK:
                    released()
        if some:
            yield from self._few(some)


_ENCODERS: dict[tuple[str, bool, int], tuple[str, PartEncoder]] = {}


def part_encoder(path: str, drops_space: bool, run: str, width: int = 4, lean: bool = False) -> PartEncoder:
    """The encoder of this process for one run of a query: tasks of that run share what is learned, within HELD bytes.

    Another run begins with nothing, so that a query repeated in one session does all its work again. A lean one holds less,
    and gives memory back after each block.
    """
    key = (path, drops_space, width)
    if key not in _ENCODERS or _ENCODERS[key][0] != run:
        _ENCODERS.clear()  # before another is made
        released()
        held, block = LEAN if lean else (HELD, BLOCK)
        _ENCODERS[key] = (run, PartEncoder(path, drops_space, held, width, block))
    return _ENCODERS[key][1]
