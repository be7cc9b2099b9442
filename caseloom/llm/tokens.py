"""Token counts by dynamic programming over prefixes.

Byte-pair encoding has one valid last token for every prefix of a word: the one whose pair with the last token of what
precedes it is never merged. So one pass over a word gives the token count of each of its prefixes. Sums over the words
of a text then answer how many tokens any prefix has, and where a budget ends, without encoding anything again.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import others, prepare, rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Longer words are counted anew each time, so that the memory for words seen before is bounded.
LONGEST_KEPT = 64


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


#: Classes of later code points depend on the version of Unicode.
PLAIN = 0x500
_LATER = re.compile(f"[^\0-{chr(PLAIN - 1)}]")


def plain_pattern(pattern: str) -> re.Pattern | None:
    """The same splitting pattern for texts of code points below PLAIN, with the classes written out: a faster engine
    takes it. None if the two do not agree."""
    every = [chr(c) for c in range(PLAIN)]
    written = pattern
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        found = regex.compile(name)
        own = "".join(re.escape(c) for c in every if found.match(c))
        # written out within brackets only
        if re.search(r"(?<![\[^}sLN])" + re.escape(name), pattern):
            return None
        written = written.replace(name, own)
    fast, slow = re.compile(written), regex.compile(pattern)
    trial = "".join(a + b for a in every for b in ("", "a", "1", "!", " "))
    return fast if fast.findall(trial) == slow.findall(trial) else None


class PrefixCounter:
    """Token counts of the prefixes of words, for a byte-pair vocabulary in the tokenizers format.

    Understood are vocabularies with byte-level letters, an optional ending of a word's last letter and one splitting
    pattern whose matches are the words; others raise an error.
    """

    def __init__(self, spec: str, most_words: int = 1_000_000):
        s = json.loads(spec)
        m, steps = s["model"], s["pre_tokenizer"]["pretokenizers"]
        split = steps[0]
        if m["type"] != "BPE" or [x["type"] for x in steps] != ["Split", "ByteLevel"] or not split["invert"]:
            raise ValueError("a byte-pair vocabulary with a splitting pattern is needed")
        if m.get("ignore_merges") or m.get("continuing_subword_prefix") or m.get("byte_fallback"):
            raise ValueError("this kind of byte-pair model is not supported")
        self.end = m.get("end_of_word_suffix") or ""
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.plain_pattern = plain_pattern(split["pattern"]["Regex"])
        self.splitter = Tokenizer.from_str(spec).pre_tokenizer
        self.lower, self.nfc = self._normalisers(s["normalizer"])
        self.special = sorted((t["content"] for t in s["added_tokens"]), key=len, reverse=True)
        self.special_split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self._tables(m)
        self.letters = byte_letters()
        #: Whether two tokens stay apart; prefix counts and totals of words seen before.
        self.apart: dict[int, bool] = {}
        self.words: dict[str, list[int]] = {}
        self.totals: dict[str, int] = {}
        self.most_words = most_words

    def _tables(self, m: dict) -> None:
        """Numbers for the tokens, ranks of pairs, and tries of the reversed tokens inside and at the end of words."""
        merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in m["merges"]]
        number: dict[str, int] = {}
        for a, b in merges:
            number.setdefault(a + b, len(number))
        merged = len(number)
        for t in m["vocab"]:
            if t not in number and (len(t) == 1 or t == self.end or t[:1] + self.end == t):
                number[t] = len(number)
        #: Rank and parts of every merged token; single letters have rank -1.
        self.rank = [-1] * len(number)
        self.parts: list[tuple[int, int] | None] = [None] * len(number)
        self.pairs: dict[int, int] = {}
        for i, (a, b) in enumerate(merges):
            if a not in number or b not in number:
                continue
            self.pairs[number[a] << 24 | number[b]] = i
            if self.parts[t := number[a + b]] is None:
                self.rank[t], self.parts[t] = i, (number[a], number[b])
        self.is_whole: list[bool | None] = [None] * merged + [True] * (len(number) - merged)
        inside, final = {}, {}
        for t, k in number.items():
            if not self.whole(k):
                continue
            if not self.end:
                homes = [(inside, t)]
            elif t.endswith(self.end) and t != self.end:
                homes = [(final, t[: -len(self.end)])]
            else:
                homes = [(inside, t)]
            for node, letters in homes:
                for c in reversed(letters):
                    node = node.setdefault(c, {})
                node[""] = k
        self.inside, self.final = inside, final if self.end else inside

    @staticmethod
    def _normalisers(spec: dict | None) -> tuple[bool, bool]:
        steps = [] if spec is None else spec["normalizers"] if spec["type"] == "Sequence" else [spec]
        for x in steps:
            # white space never belongs to a word, so what it is replaced by does not matter
            if x["type"] not in ("NFC", "Lowercase") and not (x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"}):
                raise ValueError(f"normaliser {x['type']} is not supported")
        kinds = [x["type"] for x in steps]
        return "Lowercase" in kinds, "NFC" in kinds

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether adjacent tokens a and b are never merged across their border while they are built."""
        known = self.apart.get(a << 24 | b)
        if known is not None:
            return known
        rank, parts, pairs = self.rank, self.parts, self.pairs
        left, right, before, ok = a, b, float("inf"), True
        # take the later of both last merges back, again and again; before then the border pair had its chance
        while True:
            here = pairs.get(left << 24 | right)
            if here is not None and here < before:
                ok = False
                break
            x, y = rank[left], rank[right]
            if x < 0 and y < 0:
                break
            # of equal ranks the left one is merged first, so the right one is taken back first
            if x > y:
                left, before = parts[left][1], x
            else:
                right, before = parts[right][0], y + 0.5
        if len(self.apart) > 1_000_000:
            self.apart.clear()
        self.apart[a << 24 | b] = ok
        return ok

    def whole(self, t: int) -> bool:
        """Whether a token comes out when its own letters are encoded."""
        known = self.is_whole[t]
        if known is None:
            a, b = self.parts[t] or (None, None)
            known = a is not None and self.stay_apart_below(a, b, self.rank[t]) and self.whole(a) and self.whole(b)
            self.is_whole[t] = known
        return known

    def stay_apart_below(self, a: int, b: int, rank: int) -> bool:
        """Whether nothing is merged across the border of a and b before they merge with each other."""
        left, right, before = a, b, float("inf")
        while True:
            here = self.pairs.get(left << 24 | right)
            if here is not None and here < before and (left, right) != (a, b):
                return False
            x, y = self.rank[left], self.rank[right]
            if x < 0 and y < 0:
                return True
            if max(x, y) > rank:
                return False
            if x > y:
                left, before = self.parts[left][1], x
            else:
                right, before = self.parts[right][0], y + 0.5

    def last_token(self, s: str, i: int, last: list[int], trie: dict) -> tuple[int, int]:
        """The token that ends the encoding of the first i letters, and where it begins."""
        fits, j, node = [], i, trie
        while j:
            j -= 1
            node = node.get(s[j])
            if node is None:
                break
            if "" in node:
                fits.append((node[""], j))
        apart = self.apart
        while fits:
            t, j = fits.pop()
            if not j:
                return t, j
            ok = apart.get(last[j] << 24 | t)
            if ok or (ok is None and self.stay_apart(last[j], t)):
                return t, j
        raise ValueError("a letter is missing in the vocabulary")

    def prefix_counts(self, word: str) -> list[int]:
        """Token count of every prefix of a word by characters, from none to all."""
        out = self.words.get(word)
        if out is None:
            data = word.encode()
            s = "".join([self.letters[b] for b in data])
            last, counts, closed = [0], [0], [0]
            for i in range(1, len(s) + 1):
                t, j = self.last_token(s, i, last, self.inside)
                last.append(t)
                counts.append(counts[j] + 1)
                # the same prefix as a word of its own
                closed.append(counts[self.last_token(s, i, last, self.final)[1]] + 1 if self.end else counts[i])
            at, out = 0, [0]
            for c in word:
                at += len(c.encode())
                out.append(closed[at])
            if self.pattern.fullmatch(word) and len(word) > 1:
                out = self._as_split(word, out)
            if len(word) <= LONGEST_KEPT:
                if len(self.words) >= self.most_words:
                    self.words.clear()
                self.words[word] = out
        return out

    def _as_split(self, word: str, counts: list[int]) -> list[int]:
        """A prefix that the pattern splits in several words, such as 'l of 'll, counts as these."""
        for i in range(1, len(word)):
            parts = self.pattern.findall(word[:i]) if word[0] == "'" else [word[:i]]
            if len(parts) > 1:
                counts = [*counts[:i], sum(self.prefix_counts(p)[-1] for p in parts), *counts[i + 1 :]]
        return counts

    def total(self, word: str) -> int:
        n = self.totals.get(word)
        if n is None:
            n = self.count_letters("".join([self.letters[b] for b in word.encode()]))
            if len(word) <= LONGEST_KEPT:
                if len(self.totals) >= self.most_words:
                    self.totals.clear()
                self.totals[word] = n
        return n

    def count_letters(self, s: str) -> int:
        """Tokens of one word: the last row of its tables only needs the unfinished prefixes."""
        last, count, trie, known = [0], [0], self.inside, self.apart.get
        for i in range(1, len(s)):
            # last_token, in place: this loop runs for every letter of every new word
            fits, j, node = [], i, trie
            while j:
                j -= 1
                node = node.get(s[j])
                if node is None:
                    break
                if "" in node:
                    fits.append((node[""], j))
            while fits:
                t, j = fits.pop()
                if j:
                    ok = known(last[j] << 24 | t)
                    if not (self.stay_apart(last[j], t) if ok is None else ok):
                        continue
                last.append(t)
                count.append(count[j] + 1)
                break
            else:
                raise ValueError("a letter is missing in the vocabulary")
        return count[self.last_token(s, len(s), last, self.final)[1]] + 1

    def normal(self, text: str) -> str:
        if self.nfc and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # letter by letter: a final sigma gets no form of its own
        return text.replace("Σ", "σ").lower() if self.lower else text

    def pieces(self, text: str) -> Iterator[tuple[str, bool]]:
        """Parts of a text, and whether a part is a special string, which is one token."""
        if self.special_split is None or not any(s in text for s in self.special):
            yield text, False
            return
        at = 0
        for m in self.special_split.finditer(text):
            yield text[at : m.start()], False
            yield m.group(), True
            at = m.end()
        yield text[at:], False

    def measure(self, text: str | None) -> tuple[list[tuple[str, list[str] | None]], np.ndarray]:
        """Normalised parts of a text with their words (none for a special string), and running counts at the words' ends."""
        parts: list[tuple[str, list[str] | None]] = []
        counts: list[int] = []
        total, known = self.total, self.totals
        for part, special in self.pieces(text or ""):
            if special:
                parts.append((part, None))
                counts.append(1)
                continue
            part = self.normal(part)
            if self.plain_pattern is not None and (part.isascii() or _LATER.search(part) is None):
                words = self.plain_pattern.findall(part)
            else:
                # the library knows best which letters there are
                words = [part[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(part)]
            parts.append((part, words))
            counts += [known.get(w) or total(w) for w in words]
        return parts, np.cumsum(np.array(counts, np.int64))

    def count(self, text: str | None) -> np.ndarray:
        """Running token counts at the ends of the words of a text (special strings count as words)."""
        return self.measure(text)[1]

    def cut(self, text: str | None, limit: int, measured: tuple | None = None) -> int:
        """Characters of the longest prefix of the normalised text that has at most ``limit`` tokens.

        The stored sums say in which word the limit falls, the prefixes of that word where; nothing is counted again.
        """
        parts, sums = measured or self.measure(text)
        left = int(np.searchsorted(sums, limit, side="right"))
        used = int(sums[left - 1]) if left else 0
        length = 0
        for part, words in parts:
            n = 1 if words is None else len(words)
            if left >= n:
                left, length = left - n, length + len(part)
                continue
            if words is None:
                return length
            at = 0
            for w in words[:left]:
                at = part.index(w, at) + len(w)
            word = words[left]
            start = part.index(word, at)
            fit = max(i for i, c in enumerate(self.prefix_counts(word)) if used + c <= limit)
            # nothing of the word fits: what is before it, white space too, does
            return length + start + fit
        return length

    def at(self, text: str, places: Iterable[int]) -> list[int]:
        """Exact token counts of the prefixes of a normalised text that end at the given characters."""
        spans = [(m.start(), m.end(), m.group()) for m in self.pattern.finditer(text)]
        starts = np.array([s for s, _, _ in spans], np.int64)
        sums = np.concatenate(([0], np.cumsum([self.total(w) for _, _, w in spans])))
        out = []
        for p in places:
            k = int(np.searchsorted(starts, p, side="left")) - 1
            out.append(0 if k < 0 else int(sums[k]) + self.prefix_counts(spans[k][2])[min(p, spans[k][1]) - spans[k][0]])
        return out


_COUNTERS: dict[int, PrefixCounter] = {}


def counter(spec: str) -> PrefixCounter:
    """One counter for each vocabulary and worker process; its tables serve all tasks of the process."""
    key = hash(spec)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = PrefixCounter(spec)
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """``docs`` without its text, with n_bytes, n_tokens, over_limit and fit_chars.

    ``vocabulary`` is the path of a tokenizers file, read once on the driver; its text (a few MB) travels with the
    tasks. Counts are those of the library without begin or end tokens; special strings inside a text are one token.
    fit_chars is the length of the longest prefix of the normalised text within ``limit``, null if all of it fits. Null
    and empty texts have no tokens; every row comes back, repeated ones too; columns named like an added one are replaced.
    """
    spark = prepare(docs.sparkSession)
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    added = ["n_bytes", "n_tokens", "over_limit", "fit_chars"]
    kept = others(docs, *added, "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(spec.value)
        for b in batches:
            (texts,) = next(rows([b], "text"))
            measured = [c.measure(t) for t in texts]
            n = [int(s[-1]) if len(s) else 0 for _, s in measured]
            out = [b.column(k) for k in kept] + [
                pa.array([len((t or "").encode()) for t in texts], pa.int64()),
                pa.array(n, pa.int64()),
                pa.array([x > limit for x in n]),
                pa.array([c.cut(None, limit, m) if x > limit else None for m, x in zip(measured, n, strict=True)], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(out, [*kept, *added])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*kept).schema)
    return docs.select(*kept, F.col("text")).mapInArrow(run, f"{kinds}n_bytes long, n_tokens long, over_limit boolean, fit_chars long")
