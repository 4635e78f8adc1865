"""Token counts by a map-side two-tier lookup.

A text's white-space segments are looked up in a compact table of the lengths of
frequent segments (taken from a bounded sample, broadcast), then in a cache that
lives as long as the Python worker; what both miss is encoded.  No pre-token is
shuffled, and every whole text is counted.

The vocabulary drops white space and splits words before it merges, so a text's
count is the sum over its segments.  Texts in which that could fail (special
strings, characters that normalise in context, unusual white space) are encoded
whole by the tokenizer itself.

Most misses are plain lower-case Latin words.  For them the vocabulary's merges
are also loaded as byte ranks, with one symbol for a letter inside a word and
another for the last letter; a test holds that path against the tokenizer.

Edge cases: a null or empty text has 0 bytes and 0 tokens; repeated rows are
counted alike; a null doc_id is kept."""

from __future__ import annotations

import json
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, map_texts, sampled

SAMPLE_ROWS = 2000        # texts that the frequent table is taken from
TABLE_ENTRIES = 65_536    # its size
CACHE_ENTRIES = 400_000   # segments that a worker remembers; it starts anew when full
LONGEST = 48              # code points of a segment that is remembered
LIMIT = 2048

_WORKER: dict = {}


def byte_symbols() -> dict[str, int]:
    """The printable character that a byte-level vocabulary writes for each byte,
    by its published rule: printable bytes stand for themselves, the others for
    the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class _WordRanks:
    """Counts tokens of lower-case words of a-z and U+00DF to U+00FF."""

    def __init__(self, model: dict):
        import tiktoken

        free = iter(c for c in range(2, 128) if not chr(c).isalpha() and c not in (10, 32))
        inner = {0xC3: 1} | {b: b for b in range(97, 123)} | {b: next(free) for b in range(0x9F, 0xC0)}
        last = {b: b - 32 for b in range(97, 123)} | {b: next(free) for b in range(0x9F, 0xC0)}
        to_byte, suffix = byte_symbols(), model["end_of_word_suffix"]

        def symbols(token: str) -> bytes | None:
            ends = token.endswith(suffix)
            raw = [to_byte.get(c, -1) for c in (token.removesuffix(suffix) if ends else token)]
            if not raw or any(b not in inner for b in raw) or ends and raw[-1] not in last:
                return None
            return bytes([inner[b] for b in raw[:-1]] + [(last if ends else inner)[raw[-1]]])

        ranks = {bytes([s]): s for s in {*inner.values(), *last.values()}}
        for at, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            whole = symbols(a + b)
            if whole is not None and symbols(a) is not None and len(whole) > 1:
                ranks.setdefault(whole, 1000 + at)
        ending = set(last.values())
        self.ends = np.zeros(max(ranks.values()) + 1, bool)
        self.ends[[r for s, r in ranks.items() if s[-1] in ending]] = True
        self.encode = tiktoken.Encoding("words", pat_str="[^ ]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.first, self.second = np.zeros(256, np.uint8), np.zeros((2, 256), np.uint8)
        for c in [*range(97, 123), *range(0xDF, 0x100)]:
            raw = chr(c).encode()
            self.first[c] = inner[raw[0]]
            if len(raw) == 2:
                self.second[:, c] = inner[raw[1]], last[raw[1]]

    def takes(self, word: str) -> bool:
        return word.isalpha() and max(word) < "Ā" and "÷" not in word and bool(
            self.first[np.frombuffer(word.encode("latin-1"), np.uint8)].all())

    def counts(self, words: list[str]) -> list[int]:
        code = np.frombuffer((" ".join(words) + " ").encode("latin-1"), np.uint8)
        final = np.append(code[1:] == 32, False) & (code != 32)
        wide = self.second[0][code] > 0
        out = np.full(len(code) + int(wide.sum()), 32, np.uint8)
        at = np.arange(len(code)) + np.cumsum(wide) - wide
        letter = code != 32
        plain = letter & ~wide
        out[at[plain]] = np.where(final[plain], self.first[code[plain]] - 32, self.first[code[plain]])
        out[at[wide]] = self.first[code[wide]]
        out[at[wide] + 1] = np.where(final[wide], self.second[1][code[wide]], self.second[0][code[wide]])
        ids = np.array(self.encode(out.tobytes().decode("ascii")), np.int64)
        return np.diff(np.flatnonzero(self.ends[ids]), prepend=-1).tolist()


class Counter49k:
    """Token counts for one vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"].lower() for t in spec["added_tokens"]]
        self.words = _WordRanks(spec["model"])
        self.cache: dict[str, int] = {}

    def exact(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def plain(text: str) -> bool:
        """No character that normalises in context, no white space that the two
        splitting rules see differently: those below U+0250 but a few."""
        return text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f") or (
            max(text) < "ɐ" and not any(c in text for c in "\x1c\x1d\x1e\x1f\x85\xa0"))

    def learn(self, segments: set[str]) -> dict[str, int]:
        """Counts of segments without white space.  A word before closing marks is
        counted as the word and the marks."""
        parts = {s: (w, s[len(w):]) for s in segments if (w := s.rstrip(".,")) and w.isalpha()}
        words = {w.lower() for w, _ in parts.values()}
        easy = [w for w in words if self.words.takes(w)]
        known = dict(zip(easy, self.words.counts(easy), strict=True)) if easy else {}
        rest = [*(words - known.keys()), *{p for _, p in parts.values() if p}, *(segments - parts.keys())]
        hard = dict(zip(rest, self.exact(rest), strict=True)) if rest else {}
        known |= hard
        return {s: known[parts[s][0].lower()] + (known[parts[s][1]] if parts[s][1] else 0) if s in parts else hard[s]
                for s in segments}

    def counts(self, texts: list[str | None], frequent: dict[str, int]) -> list[int]:
        out, open_, missed = [0] * len(texts), [], set()
        whole = []
        for i, t in enumerate(texts):
            if not t:
                continue
            if not self.plain(t) or "<|" in t and any(s in t.lower() for s in self.special):
                whole.append(i)
                continue
            rest = []
            got = 0
            for s, n in zip(segs := t.split(), map(frequent.get, segs)):
                if n is None:
                    rest.append(s)
                else:
                    got += n
            out[i] = got
            if rest:
                open_.append((i, rest))
                missed.update(rest)
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        new = self.learn({s for s in missed if s not in self.cache})
        self.cache.update((s, n) for s, n in new.items() if len(s) <= LONGEST)
        for i, rest in open_:
            out[i] += sum(new[s] if s in new else self.cache[s] for s in rest)
        for i, n in zip(whole, self.exact([texts[i] for i in whole]), strict=True):
            out[i] = n
        return out


def _counter(path: str) -> Counter49k:
    if _WORKER.get("path") != path:
        _WORKER.update(path=path, counter=Counter49k(path))
    return _WORKER["counter"]


def frequent_lengths(docs: DataFrame, path: str, rows: int = SAMPLE_ROWS, entries: int = TABLE_ENTRIES) -> dict[str, int]:
    """Token counts of the most frequent segments of at most ``rows`` texts (those
    with the smallest hashes).  The table has at most ``entries`` segments of at
    most ``LONGEST`` code points; what it holds changes the speed only."""
    def most(part: pd.DataFrame) -> pd.DataFrame:
        counter, seen = _counter(path), Counter()
        for t in part["text"].sort_values():
            if counter.plain(t):
                seen.update(s for s in t.split() if len(s) <= LONGEST)
        top = [s for s, _ in seen.most_common(entries)]
        known = counter.learn(set(top))
        return pd.DataFrame({"segment": top, "n": [known[s] for s in top]})

    # Twice the rows are drawn by hash, so that the limit is met whatever the draw.
    sample = (sampled(docs.where(F.length("text") > 0).select("text"), F.col("text"), 2 * rows)
              .orderBy(F.xxhash64("text")).limit(rows))
    found = sample.groupBy(F.lit("all").alias("_all")).applyInPandas(most, "segment string, n int").collect()
    return {r.segment: r.n for r in found}


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row."""
    docs = columns(docs, "doc_id", "text")
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path))

    def make():
        counter = _counter(path)

        def count(texts: list) -> dict:
            n = counter.counts(texts, table.value)
            return {"n_bytes": [len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts], "n_tokens": n,
                    "over_limit": [x > limit for x in n]}
        return count

    return map_texts(docs, make, "n_bytes bigint, n_tokens bigint, over_limit boolean")
