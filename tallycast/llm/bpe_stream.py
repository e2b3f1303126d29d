"""Byte-pair encoding by a bounded-lookahead streaming transducer, and its inverse.

The vocabulary file (its path is a parameter) holds the ids, the merge list, the
special tokens and an end-of-word suffix. The transducer reads a text piece by
piece: special tokens, Unicode composition, lower case, pre-tokens, merges. A
pre-token of any length is encoded in constant memory, because a symbol's token
cannot depend on what comes more than ``lookahead`` symbols later, a number that
the merge list determines (see ``sufficient_lookahead``): tokens that end before
that distance are emitted, and the merges start anew after them.

Decoding goes id by id through a state machine: bytes enter, characters leave as
soon as they are complete.

Character classes and case are those of the installed Unicode tables; code
points that one library's tables do not know yet may fall into another class.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import bounded_batches

PIECE = 1 << 16   # characters of a text that are read at a time
STEP = 512        # symbols gathered beyond the lookahead before merges are tried
SHORT = 64        # longer runs without white space go through the transducer
CACHE = 1 << 18   # runs and words whose encoding a worker remembers
LEARN = 1 << 21   # characters of texts whose new runs are encoded together

# The pre-token pattern, the white space that parts pre-tokens.
_SPACES = "\t-\r " + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_L, _N, _O = r"\p{L}", r"\p{N}", rf"[^{_SPACES}\p{{L}}\p{{N}}]"
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_PRETOKEN = regex.compile(f"{_CONTRACTIONS}|{_L}+|{_N}|{_O}+")
_CONTRACTION, _LETTERS, _NUMBER, _OTHER = map(regex.compile, (_CONTRACTIONS, f"{_L}+", _N, f"{_O}+"))
_RUNS = re.compile(f"[^{_SPACES}]+")
_SPACE = re.compile(f"[{_SPACES}]+")
_NO_SPACE = re.compile("[\x1c-\x1f]")  # parted by str.split(), but not white space here


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte: its own where it has
    one, the others in order from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in set(own))}
    return [rest.get(b) or chr(b) for b in range(256)]


LETTERS = _byte_letters()
BYTES = {c: b for b, c in enumerate(LETTERS)}


def sufficient_lookahead(merges: list[tuple[str, str]], length) -> int:
    """How many symbols after a place suffice to know the tokens before it.

    Merges apply by rank. Let a text be extended. The first merge that happens
    in one of the two runs only has its left part at the end of the text; a
    site where they differ at rank r, by the merge (u, v), has the token u or uv,
    or what later merges make of it to the right. A merge of higher rank that
    takes one of these as its right part carries the difference left by the
    length of its own left part. Ranks only rise, so the greatest distance is a
    longest path over the merges, found from the last merge to the first.
    """
    to_left: dict[str, int] = {}   # token -> distance that later merges with it as right part can carry
    on_site: dict[str, int] = {}   # token -> the same for later merges with it as left part
    most = 0
    for u, v in reversed(merges):
        carried = max(to_left.get(u, 0), to_left.get(u + v, 0), on_site.get(u, 0), on_site.get(u + v, 0))
        to_left[v] = max(to_left.get(v, 0), length(u) + carried)
        on_site[u] = max(on_site.get(u, 0), carried)
        most = max(most, length(u) + carried)
    return most


class Vocabulary:
    """What a vocabulary file says. Raises where a merge needs a token that a
    later merge makes: tokens could then depend on symbols without bound."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.ranks = {m: i for i, m in enumerate(merges)}
        made: dict[str, int] = {}
        for i, (u, v) in enumerate(merges):
            made.setdefault(u + v, i)
        if any(made.get(t, -1) > i for i, m in enumerate(merges) for t in m):
            raise ValueError("the merge list uses a token before it is made")
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")
        self.widest = max(map(len, self.specials), default=1)
        self.lookahead = sufficient_lookahead(merges, lambda t: len(t.removesuffix(self.suffix) if self.suffix else t))
        self.spelling = {i: t for t, i in (*self.ids.items(), *self.specials.items())}
        self.runs = _Runs(self)
        self.words: dict[str, tuple[int, ...]] = {}
        # the merge list as an open hash table of pairs of ids, for many words at once
        self.width = max(self.ids.values()) + 1
        self.merged_id = np.array([self.ids[u + v] for u, v in merges], np.int64)
        bits = max(8, (4 * len(merges)).bit_length())
        self.shift, self.keys, self.rank_at = np.uint64(64 - bits), np.full((1 << bits) + 64, -1, np.int64), np.zeros((1 << bits) + 64, np.int32)
        pairs = np.array([self.ids[u] * self.width + self.ids[v] for u, v in merges], np.int64)
        for key, at, rank in zip(pairs.tolist(), self._slot(pairs).tolist(), range(len(merges))):
            while self.keys[at] >= 0:
                at += 1
            self.keys[at], self.rank_at[at] = key, rank
        self.first = np.array([self.ids.get(c, -1) for c in LETTERS], np.int64)
        self.final = np.array([self.ids.get(c + self.suffix, -1) for c in LETTERS], np.int64)

    def merged(self, symbols: list[str]) -> list[str]:
        """The tokens of a list of symbols: always the merge of lowest rank, the leftmost first."""
        s, rank, none = list(symbols), self.ranks.get, len(self.ranks)
        ranks = [rank(p, none) for p in zip(s, s[1:])]
        while ranks and (low := min(ranks)) < none:
            i = ranks.index(low)
            s[i:i + 2] = [s[i] + s[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((s[i - 1], s[i]), none)
            if i < len(ranks):
                ranks[i] = rank((s[i], s[i + 1]), none)
        return s

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _ranks(self, pairs: np.ndarray) -> np.ndarray:
        """Rank of every pair of ids, the number of merges where there is none."""
        out = np.full(len(pairs), len(self.ranks), np.int32)
        at, todo = self._slot(pairs), np.arange(len(pairs))
        while len(todo):
            found = self.keys[at]
            hit = found == pairs[todo]
            out[todo[hit]] = self.rank_at[at[hit]]
            go = ~hit & (found >= 0)
            at, todo = at[go] + 1, todo[go]
        return out

    def learn(self, runs: set[str]) -> None:
        """Encodes the short runs that are not remembered yet: the merges of all
        their words advance together, a merge a word at a time."""
        if len(self.runs) > CACHE:
            self.runs.clear()
        if len(self.words) > CACHE:
            self.words.clear()
        fresh = [r for r in runs.difference(self.runs) if len(r) <= SHORT and not ("<" in r and self.special.search(r))]
        parts = [_PRETOKEN.findall(r.lower() if r.isascii() else normal(r)) for r in fresh]
        words = [w for w in dict.fromkeys(chain.from_iterable(parts)) if w not in self.words]
        self.words.update(zip(words, self._merge_all(words)))
        of = self.words.__getitem__
        self.runs.update((r, of(p[0]) if len(p) == 1 else tuple(chain.from_iterable(map(of, p)))) for r, p in zip(fresh, parts))

    def _merge_all(self, words: list[str]) -> list[tuple[int, ...]]:
        if not words:
            return []
        data = [w.encode() for w in words]
        sizes = np.array(list(map(len, data)))
        flat = np.frombuffer(b"".join(data), np.uint8)
        ids, ends = self.first[flat], np.cumsum(sizes) - 1
        ids[ends] = self.final[flat[ends]]
        if (ids < 0).any():
            raise KeyError("the vocabulary lacks a byte")
        which, none, done = np.repeat(np.arange(len(words)), sizes), len(self.ranks), []
        while len(ids):
            ranks = np.append(self._ranks(ids[:-1] * self.width + ids[1:]), np.int32(none))
            ranks[:-1][which[:-1] != which[1:]] = none
            starts = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
            low = np.repeat(np.minimum.reduceat(ranks, starts), np.diff(np.append(starts, len(ids))))
            rest = low == none
            done.append((which[rest], ids[rest]))
            ids, which, ranks, low = ids[~rest], which[~rest], ranks[~rest], low[~rest]
            at = np.flatnonzero(ranks == low)
            at = at[np.append(True, which[at[1:]] != which[at[:-1]])] if len(at) else at  # the leftmost of a word
            ids[at] = self.merged_id[ranks[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, which = ids[keep], which[keep]
        which, ids = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(which, kind="stable")
        cuts = np.cumsum(np.bincount(which, minlength=len(words))).tolist()
        tokens = ids[order].tolist()
        return [tuple(tokens[a:b]) for a, b in zip([0, *cuts[:-1]], cuts)]

    def last(self, symbols: list[str]) -> list[int]:
        """Ids of symbols that end their pre-token."""
        return [self.ids[t] for t in self.merged([*symbols[:-1], symbols[-1] + self.suffix])]

    def word(self, word: str) -> tuple[int, ...]:
        got = self.words.get(word)
        if got is None:
            if len(self.words) > CACHE:
                self.words.clear()
            got = self.words[word] = tuple(self.last([LETTERS[b] for b in word.encode()]))
        return got


class _Runs(dict):
    """Run without white space -> its ids. Short ones are remembered; those with
    special tokens and long ones go through the transducer."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.v = vocabulary

    def __missing__(self, run: str) -> tuple[int, ...]:
        if len(run) > SHORT or self.v.special.search(run):
            t = Transducer(self.v)
            return (*t.feed(run), *t.close())
        if len(self) > CACHE:
            self.clear()
        got = self[run] = tuple(i for w in _PRETOKEN.findall(normal(run)) for i in self.v.word(w))
        return got


def normal(text: str) -> str:
    """Composed characters, each lowered by itself (no rule for final sigma)."""
    return unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()


def _starts_anew(c: str) -> bool:
    """No character before ``c`` composes with it."""
    return unicodedata.category(c)[0] != "M" and not 0x1100 <= ord(c) < 0x1200 and not 0xD7B0 <= ord(c) < 0xD800


class Transducer:
    """Text in pieces to ids; holds a few characters and at most ``lookahead``
    + ``STEP`` symbols, and beyond that only combining marks in a row."""

    def __init__(self, vocabulary: Vocabulary, step: int = STEP):
        self.v, self.step = vocabulary, step
        self.raw = ""                 # not yet known to be free of special tokens and to be composed
        self.text = ""                # normal text of which no pre-token has begun
        self.kind = None              # pattern of the open pre-token
        self.symbols: list[str] = []  # of the open pre-token, not yet emitted

    def feed(self, piece: str) -> list[int]:
        self.raw += piece
        cut = len(self.raw) - self.v.widest
        while cut > 0 and not _starts_anew(self.raw[cut]):
            cut -= 1
        out: list[int] = []
        if cut > 0:
            for m in self.v.special.finditer(self.raw, 0, cut + self.v.widest - 1):
                if m.start() < cut < m.end():
                    cut = m.start()
            head, self.raw = self.raw[:cut], self.raw[cut:]
            self._split(head, out)
        return out

    def close(self) -> list[int]:
        """Ends the text; the transducer may then read another one."""
        out: list[int] = []
        self._split(self.raw, out)
        self._pretokens(out, True)
        self.raw = ""
        return out

    def _split(self, raw: str, out: list[int]) -> None:
        at = 0
        for m in self.v.special.finditer(raw):
            self.text += normal(raw[at:m.start()])
            self._pretokens(out, True)
            out.append(self.v.specials[m.group()])
            at = m.end()
        self.text += normal(raw[at:])
        self._pretokens(out, False)

    def _pretokens(self, out: list[int], end: bool) -> None:
        text, at = self.text, 0
        while at < len(text):
            if self.kind is None:
                if m := _SPACE.match(text, at):
                    at = m.end()
                    continue
                if text[at] == "'" and len(text) - at < 3 and not end:
                    break  # may become a contraction
                if (m := _CONTRACTION.match(text, at)) or (m := _NUMBER.match(text, at)):
                    out.extend(self.v.word(m.group()))
                    at = m.end()
                    continue
                self.kind = _LETTERS if _LETTERS.match(text, at) else _OTHER
            m = self.kind.match(text, at)
            if m:
                self._symbols(m.group(), out)
                at = m.end()
            if at < len(text):
                self._end_word(out)
        self.text = text[at:]
        if end:
            self._end_word(out)

    def _symbols(self, part: str, out: list[int]) -> None:
        for i in range(0, len(part), self.step):
            self.symbols += [LETTERS[b] for b in part[i:i + self.step].encode()]
            if len(self.symbols) > self.v.lookahead + self.step:
                known = self.symbols[:-1]  # the last one may yet end the pre-token
                stable, done = len(known) - self.v.lookahead, 0
                for t in self.v.merged(known):
                    if done + len(t) > stable:
                        break
                    out.append(self.v.ids[t])
                    done += len(t)
                del self.symbols[:done]

    def _end_word(self, out: list[int]) -> None:
        if self.symbols:
            out.extend(self.v.last(self.symbols))
        self.symbols, self.kind = [], None


def encode_text(v: Vocabulary, text: str) -> array:
    """Ids of a whole text, read in pieces; runs that a piece cuts go on in the transducer."""
    out, at, n = array("i"), 0, len(text)
    while at < n:
        end = min(n, at + PIECE)
        if end < n:
            last = next((i for i in range(end, max(at, end - 4 * SHORT), -1) if _SPACE.match(text, i)), None)
            if last is None:  # a long run: from its start to the next white space, piece by piece
                start = max((m.end() for m in _SPACE.finditer(text, at, end)), default=at)
                out.extend(chain.from_iterable(map(v.runs.__getitem__, _runs(text[at:start]))))
                t, at = Transducer(v), start
                while True:
                    m = _SPACE.search(text, at, at + PIECE)
                    out.extend(t.feed(text[at:m.start() if m else at + PIECE]))
                    at = m.end() if m else min(n, at + PIECE)
                    if m or at >= n:
                        break
                out.extend(t.close())
                continue
            end = last
        out.extend(chain.from_iterable(map(v.runs.__getitem__, _runs(text[at:end]))))
        at = end
    return out


def _runs(text: str) -> list[str]:
    return _RUNS.findall(text) if _NO_SPACE.search(text) else text.split()


class Decoder:
    """Ids to text, one at a time. ``as_spelled`` gives the tokens as the
    vocabulary spells them, a space between them, which is what a vocabulary
    without a decoder decodes to; otherwise bytes become characters as soon as
    they are complete, and a word's end a space."""

    def __init__(self, vocabulary: Vocabulary, as_spelled: bool):
        self.v, self.as_spelled = vocabulary, as_spelled
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        self.first = True

    def feed(self, ids) -> str:
        if self.as_spelled:
            text = " ".join(map(self.v.spelling.__getitem__, ids))
            text, self.first = text if self.first or not len(ids) else f" {text}", self.first and not len(ids)
            return text
        return "".join(map(self._one, ids))

    def _one(self, i: int) -> str:
        token = self.v.spelling[i]
        if token in self.v.specials:
            return self.utf8.decode(b"", True) + token
        ends = self.v.suffix and token.endswith(self.v.suffix)
        core = token.removesuffix(self.v.suffix) if ends else token
        return self.utf8.decode(bytes(BYTES[c] for c in core)) + (" " if ends else "")

    def close(self) -> str:
        return self.utf8.decode(b"", True)


_LOADED: dict[str, Vocabulary] = {}


def _vocabulary(data: bytes) -> Vocabulary:
    """One parsed vocabulary, with its caches, a Python worker."""
    key = hashlib.sha256(data).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(data)
    return _LOADED[key]


def _shared(df: DataFrame, path: str):
    """The file, read once by the driver; its size does not depend on the data."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Adds ``out``, the ids of the whole ``text`` of every row, as the vocabulary
    file at ``path`` has them (special tokens in the text count as such, none
    are added).

    Null and empty texts, and texts of white space only, have no ids. All other
    columns stay, a column named like ``out`` is replaced; repeated rows stay
    repeated, an empty table stays empty. Long texts are read in pieces.
    """
    bounded_batches(docs.sparkSession)
    data = _shared(docs, path)
    keep = [c for c in docs.columns if c != out]
    src = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_encoded_text"))

    def run(batches):
        v = _vocabulary(data.value)
        for b in batches:
            ids, ends = array("i"), [0]
            texts = b.column(len(keep)).to_pylist()
            at = 0
            while at < len(texts):  # texts of about LEARN characters share the work on their new runs
                end, n, new = at, 0, set()
                while end < len(texts) and n < LEARN:
                    n += len(texts[end])
                    if len(texts[end]) < LEARN:
                        new.update(_runs(texts[end]))
                    end += 1
                v.learn(new)
                for t in texts[at:end]:
                    ids.extend(encode_text(v, t))
                    ends.append(len(ids))
                at = end
            lists = pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), pa.array(np.frombuffer(ids, np.int32) if ids else np.zeros(0, np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], lists], [*keep, out])

    return src.mapInArrow(run, StructType([*src.schema.fields[:len(keep)], StructField(out, ArrayType(IntegerType()))]))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded", as_spelled: bool = True) -> DataFrame:
    """Adds ``out``, the text of the ``ids`` of every row (see ``Decoder``; null
    or no ids: empty). Other columns stay, one named like ``out`` is replaced."""
    bounded_batches(df.sparkSession)
    data = _shared(df, path)
    keep = [c for c in df.columns if c != out]
    src = df.select(*keep, F.col(ids).cast("array<int>").alias("_decoded_ids"))

    def run(batches):
        v = _vocabulary(data.value)
        for b in batches:
            lists = b.column(len(keep))
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            texts = []
            for start, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
                d = Decoder(v, as_spelled)
                texts.append("".join(d.feed(flat[i:min(end, i + PIECE)].tolist()) for i in range(start, end, PIECE)) + d.close())
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(texts, pa.string())], [*keep, out])

    return src.mapInArrow(run, StructType([*src.schema.fields[:len(keep)], StructField(out, StringType())]))
