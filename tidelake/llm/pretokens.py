"""Pre-tokens of the public byte-level vocabularies, and the caches that hold what they become."""

from __future__ import annotations

import codecs
import re
import string
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from public_tokenizers import PATTERN

from tidelake.llm.common import worker_cache

# Code points of the basic plane whose class differs between the Unicode tables of the
# tokenizers library and those of the regex module (every code point was compared).
NEWER = r"՘֋֌࢏౜೜₏₝-₟꟎꟏꟒꟔꟝꟢꟱꭬꭭"

#: A text with one of these, or anything beyond the basic plane, is left whole to the library.
UNSURE = regex.compile(f"[{NEWER}\U00010000-\U0010ffff]")

split = regex.compile(PATTERN).findall

#: Marks that are neither letters, digits nor blanks.
_MARKS = string.punctuation

#: A blank, a space, and a blank or the end: only there can a pre-token hold a space further on than
#: at its start. Any other text may be cut before every space.
RUN = re.compile(r" (?<=\s )(?:\s|\Z)")

#: Words whose values are put together at a time.
GATHERED_WORDS = 1 << 16

#: Words that go to the library's model as one.
JOINED_WORDS = 64

#: Entries of one generation of a worker's caches; there are two generations.
WORD_ENTRIES = 300_000
TOKEN_ENTRIES = 100_000


class Memo(dict):
    """Key -> value. A miss is computed and kept in the young generation.

    When that is full it becomes the old one, and what the old one still held is forgotten; an old
    entry that is asked for is young again. ``fixed`` entries are never forgotten.
    """

    def __init__(self, fixed: dict, compute: Callable, limit: int):
        super().__init__(fixed)
        self._fixed, self._compute, self._limit, self._old = fixed, compute, limit + len(fixed), {}

    def __missing__(self, key):
        value = self.known(key)
        if value is None:
            value = self._compute(key)
            self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self) >= self._limit:
            self._old = dict(self)
            self.clear()
            self.update(self._fixed)
        self[key] = value

    def known(self, key):
        """The value of an old entry, which is young again; None if it would have to be computed."""
        value = self._old.pop(key, None)
        if value is not None:
            self.keep(key, value)
        return value


class Pieces:
    """Combines what ``compute`` gives for each pre-token of a text, by ``join``.

    Two caches: of words between two spaces, which spares most of the splitting, and of pre-tokens.
    The letters at the head of a word such as ``then,`` are looked up as the word they would be alone.
    ``many``, where it is given, is ``compute`` for a list of words of letters, each after a space.
    """

    def __init__(
        self, compute: Callable, join: Callable, fixed: dict | None = None, words: int = WORD_ENTRIES, many: Callable | None = None
    ):
        fixed = fixed or {}
        tokens = Memo(fixed, compute, TOKEN_ENTRIES)
        self._token = tokens.__getitem__
        self._join = join

        def word(text: str):
            if text.isalpha():  # letters only are one pre-token
                return compute(" " + text)
            if (head := text.rstrip(_MARKS)).isalpha():  # and so are the marks behind them
                return join((self._word(head), self._token(text[len(head) :])))
            head, *rest = split(" " + text)
            if head[1:].isalpha():
                return join((self._word(head[1:]), *map(self._token, rest)))
            return join((self._token(head), *map(self._token, rest)))

        known = {t[1:]: v for t, v in fixed.items() if t[:1] == " " and t[1:].isalpha()}
        self._words, self._many = Memo(known, word, words), many
        self._word = self._words.__getitem__

    def _values(self, words: list[str]) -> list:
        """What distinct words become; those of letters only that the cache lacks are computed all at once."""
        known, young = self._words.known, self._words.get
        values = list(map(young, words))
        lacking = [i for i, value in enumerate(values) if value is None]
        if self._many:
            new, other = [], []
            for i in lacking:
                values[i] = known(words[i])
                if values[i] is None:
                    (new if words[i].isalpha() else other).append(i)
            # a head that is also among the words is computed twice at most, as nothing depends on where
            heads = {words[i].rstrip(_MARKS) for i in other}
            heads = [h for h in heads if h.isalpha() and young(h) is None and known(h) is None]
            for i, value in zip(new, found := self._many([words[i] for i in new] + heads)):
                values[i] = value
                self._words.keep(words[i], value)
            for head, value in zip(heads, found[len(new) :]):
                self._words.keep(head, value)
            lacking = other
        for i in lacking:
            values[i] = self._word(words[i])
        return values

    def all(self, texts: list[str]) -> list[bytes]:
        """``of`` for each text, if values are 32-bit numbers as bytes; a word is looked up once for all texts."""
        runs = [RUN.search(t) is not None for t in texts]
        plain = [t for t, run in zip(texts, runs) if not run]
        cut = pc.split_pattern(pa.array(plain, pa.string()), " ")
        offsets, coded = cut.offsets.to_numpy(), cut.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        values = [*self._values(words), *(self._join(map(self._token, split(t.partition(" ")[0]))) for t in plain)]
        index = coded.indices.to_numpy().copy()
        index[offsets[:-1]] = np.arange(len(words), len(values))  # no space stands before a text
        numbers = np.frombuffer(self._join(values), np.uint32)
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // numbers.itemsize
        starts, parts = np.cumsum(sizes) - sizes, []
        for at in range(0, len(index), GATHERED_WORDS):
            some = index[at : at + GATHERED_WORDS]
            ends = np.cumsum(sizes[some])
            first = starts[some] - (ends - sizes[some])
            parts.append(numbers[np.repeat(first, sizes[some]) + np.arange(ends[-1])].tobytes())
        raw = b"".join(parts)
        bounds = (np.concatenate(([0], np.cumsum(sizes[index])))[offsets] * numbers.itemsize).tolist()
        found = iter([raw[a:b] for a, b in zip(bounds, bounds[1:])])
        return [self.of(t) if run else next(found) for t, run in zip(texts, runs)]

    def of(self, text: str):
        if RUN.search(text):
            return self._join(map(self._token, split(text)))
        first, *rest = text.split(" ")
        return self._join((self._join(map(self._token, split(first))), *map(self._word, rest)))


class Library:
    """The tokenizers library behind pre-token caches: the same ids as encoding the text at once.

    The shortcut needs a byte-level vocabulary without normaliser; texts that hold a special string
    or a code point in ``UNSURE``, and every text of another kind of vocabulary, go to the library
    whole, so that its defaults hold.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec.get("pre_tokenizer") or {}
        self.plain = (
            pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space", True)
            and spec.get("normalizer") is None
            and spec["model"]["type"] == "BPE"
            and not spec["model"].get("dropout")
        )
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        if self.plain:
            self._tokenize, self._letters = self.tokenizer.model.tokenize, _byte_letters()
            self._opens = _openers(spec["model"], self._letters)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def token(self, token: str) -> list[int]:
        """Ids of one pre-token, by the library's model."""
        letters = codecs.charmap_decode(token.encode(), "strict", self._letters)[0]
        return [t.id for t in self._tokenize(letters)]

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, each after a space, as unsigned 32-bit integers.

        No merge of the vocabulary reaches from a letter across the space behind it, so the model takes
        many words in a row apart just as it does each; a token that begins with a space begins a word.
        """
        if self._opens is None:
            return [array("I", self.token(" " + w)).tobytes() for w in words]
        ids = array("I")
        for at in range(0, len(words), JOINED_WORDS):
            ids.extend(self.token(" " + " ".join(words[at : at + JOINED_WORDS])))
        first = np.flatnonzero(self._opens[np.frombuffer(ids, np.uint32)]) * ids.itemsize
        raw, ends = ids.tobytes(), [*first[1:].tolist(), len(ids) * ids.itemsize]
        return [raw[a:b] for a, b in zip(first.tolist(), ends)]

    def splits(self, text: str) -> bool:
        """Whether the text may be encoded pre-token by pre-token."""
        if not self.plain or any(s in text for s in self.specials):
            return False
        if text.isascii():
            return True
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return not UNSURE.search(text)
        return True


def _openers(model: dict, letters: str) -> np.ndarray | None:
    """Which ids begin with a space, if the model takes words of letters in a row apart as it does each.

    That is so if it merges by rank alone, has a token for each byte, and no token in which a space
    follows anything but white space.
    """
    vocab, space = model["vocab"], letters[ord(" ")]
    byte = {letter: b for b, letter in enumerate(letters)}

    def reaches(token: str) -> bool:
        if space not in token.lstrip(space):
            return False
        try:
            return not bytes(byte[c] for c in token).decode().isspace()
        except (KeyError, UnicodeDecodeError):
            return True

    odd = ("continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
    if any(model.get(o) for o in odd) or not all(c in vocab for c in letters) or any(map(reaches, vocab)):
        return None
    opens = np.zeros(max(vocab.values()) + 1, bool)
    opens[[i for token, i in vocab.items() if token.startswith(space)]] = True
    return opens


def _byte_letters() -> str:
    """The printable letters that byte-level vocabularies write for the 256 bytes."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    letters = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return "".join(letters[b] for b in range(256))


def library(path: str) -> Library:
    """One per worker and vocabulary."""
    known = worker_cache("library")
    if path not in known:
        known[path] = Library(path)
    return known[path]
