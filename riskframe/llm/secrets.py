"""Secret scan: fixed base patterns, and the guess cost of values that stand behind a credential word.

The guess cost is the least number of guesses over all segmentations of a value into
dictionary words, dates, repeats, keyboard walks and brute-force spans, found by
dynamic programming. A value that costs at least ``COST_LIMIT`` (log10) is a secret,
whatever characters it has. The dictionary is a short list of words that people put
into passwords, then the words of two public tokenizer vocabularies, English and of
several languages, which are ordered by how common a word is.

Defined results: NULL is an empty text and has no spans; spans are code points, the
end exclusive; every row is handled by itself, so repeated rows and ids do not matter.
Patterns run in time proportional to the text.
"""

from __future__ import annotations

import json
import math
import re
from base64 import b64decode
from functools import cache
from itertools import chain, zip_longest

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import plain

#: log10 of the guesses from which a credential value counts as a secret.
COST_LIMIT = 9.0
KINDS = ("assign", "access", "hex", "guess")

SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
)
SCAN = T.StructType([T.StructField("base", T.ArrayType(SPAN)), T.StructField("added", T.ArrayType(SPAN))])
_SPAN_ARROW = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_SCAN_ARROW = pa.struct([("base", pa.list_(_SPAN_ARROW)), ("added", pa.list_(_SPAN_ARROW))])

ASSIGN = re.compile(
    r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs of fewer than sixteen are dropped in any case, so only longer ones are matched.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
#: A credential word and what stands between it and its value.
CONTEXT = re.compile(
    r"(?ai:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credentials?)"
    r"[\"']?\x20*(?:[:=]|\x20is\x20)\x20*([\"']?)"
)
_RUN = re.compile(r"[!-~]*")
#: The closing quote of a quoted value: not escaped, and nothing of a value behind it.
_CLOSING = {q: re.compile(rf"(?<!\\){q}(?![^,;:&)\]}}>.\"'\\\x20])") for q in "\"'"}
#: Ends a value if a key follows; the keys of connection strings may hold blanks.
_DELIMITERS = re.compile(r"[\"',;&{}\[\])\\]+")
_ENDING = frozenset("\"',;&{}")
_KEY = re.compile(r"\x20*+\\?[\"']?[A-Za-z_][\w.-]*+\\?[\"']?\x20*+[:=]", re.ASCII)
_LONG_KEY = re.compile(r"\x20*+[A-Za-z_][\w.-]*+(?:\x20[\w.-]++){0,2}+\x20*+=", re.ASCII)
_TRIM = "\"',;.)]}>"
LEAST_LENGTH = 6

# Words that people put into passwords, most common first; they rank before those of the vocabularies.
COMMON_WORDS = """password pass word admin login user welcome letmein master secret dragon monkey
football baseball soccer hockey summer winter spring autumn monday tuesday wednesday thursday friday saturday sunday
january february march april june july august september october november december love hello sunshine princess
shadow superman batman trustno starwars flower cheese computer internet server test guest root qwerty mustang
michael jordan jennifer ashley daniel thomas robert charlie andrew jessica michelle maggie ginger summer hunter
killer pepper buster access freedom whatever matrix money silver golden orange yellow purple green black white
blue red the and you for change temp default token key api my new old your home work office company""".split()
KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
_LEET = str.maketrans("@4310$57!8", "aaeiosstib")

@cache
def _ranks() -> tuple[dict[str, int], int]:
    """The rank of each word, and the length of the longest. The vocabularies take turns, rank by rank."""
    suffix = "</w>"
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    english = [t.removesuffix(suffix) for t in sorted(vocabulary, key=vocabulary.get) if t.endswith(suffix) and t.isascii()]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        tokens = [b64decode(line.split()[0]) for line in sorted(f, key=lambda x: int(x.split()[1]))]
    many = [t[1:].decode("utf-8", "ignore").lower() for t in tokens if t[:1] == b" "]
    ranks: dict[str, int] = {}
    both = chain.from_iterable(zip_longest(english, many, fillvalue=""))
    for word in chain(COMMON_WORDS, (w for w in both if len(w) > 2 and w.isalpha())):
        ranks.setdefault(word, len(ranks) + 1)
    return ranks, max(map(len, ranks))


_NEXT_KEY = {(a, b) for row in KEY_ROWS for a, b in zip(row, row[1:])}
_NEXT_KEY |= {(b, a) for a, b in _NEXT_KEY}
_YEAR, _MONTH, _DAY, _SEP = r"(?:19|20)[0-9]{2}", r"(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12][0-9]|3[01])", r"[-/.]?"
#: Dates of each length, with the number of days (or months) in a year that they tell apart.
_DATES = [
    (re.compile(_YEAR), 1),
    (re.compile(_YEAR + _SEP + _MONTH), 12),
    (re.compile(_YEAR + _SEP + _MONTH + _SEP + _DAY), 366),
    (re.compile(_DAY + _SEP + _MONTH + _SEP + _YEAR), 366),
]
_YEARS = 130
_LEAST_RUN = 3
_WALKS = 47 * 2


def _char_cost(c: str) -> float:
    if c.isdigit():
        return 1.0
    return math.log10(26) if c.isalpha() and c.isascii() else math.log10(33)


def _matches(value: str) -> dict[int, list[tuple[int, float]]]:
    """For each end, the (start, log10 guesses) of the words and dates that end there."""
    out: dict[int, list[tuple[int, float]]] = {}
    n, low = len(value), value.lower()
    plainer = low.translate(_LEET)
    ranks, longest = _ranks()
    for start in range(n):
        for end in range(start + 2, min(n, start + longest) + 1):
            for form, extra in ((low, 0.0), (plainer, math.log10(2))):
                rank = ranks.get(form[start:end])
                if rank:
                    case = 0.0 if value[start:end] == low[start:end] else math.log10(2)
                    out.setdefault(end, []).append((start, math.log10(rank) + extra + case))
                    break
    for start in range(n):
        if value[start] in "0123":
            for date, days in _DATES:
                m = date.match(value, start)
                if m:
                    out.setdefault(m.end(), []).append((start, math.log10(_YEARS * days)))
    return out


class _Run:
    """The cheapest way to end inside a run of repeats or of neighbouring keys, over all starts inside the run.

    A span costs a fixed part and the logarithm of its length. An earlier start that is no dearer than a later one stays
    so at every further end, as its logarithm grows more slowly; so the later one is dropped for good.
    """

    def __init__(self, value: str, joined) -> None:
        self.value, self.joined, self.first = value, joined, 0
        self.starts: list[int] = []

    def least(self, end: int, best: list[float]) -> float:
        """Least cost up to ``end`` without the fixed part; ends come one after the other."""
        if end > 1 and not self.joined(self.value[end - 2], self.value[end - 1]):
            self.first, self.starts = end - 1, []
        if end - _LEAST_RUN >= self.first:
            self.starts.append(end - _LEAST_RUN)
        kept, least = [], math.inf
        for start in self.starts:
            cost = best[start] + math.log10(end - start)
            if cost < least:
                kept.append(start)
                least = cost
        self.starts = kept
        return least


def _neighbours(a: str, b: str) -> bool:
    """Next to each other on the keyboard or in the alphabet."""
    return (a, b) in _NEXT_KEY or abs(ord(a) - ord(b)) == 1


def _block_repeats(value: str) -> tuple[str, int]:
    """The shortest block that the whole value repeats, and how often."""
    at = (value + value).find(value, 1)
    return value[:at], len(value) // at


def guess_cost(value: str) -> float:
    """log10 of the guesses that the cheapest segmentation needs."""
    if not value:
        return 0.0
    matches = _matches(value)
    low = value.lower()
    repeats, walks = _Run(value, str.__eq__), _Run(low if len(low) == len(value) else value, _neighbours)
    best = [0.0] * (len(value) + 1)
    for end in range(1, len(value) + 1):
        one = _char_cost(value[end - 1])
        best[end] = min(best[end - 1] + one, repeats.least(end, best) + one, walks.least(end, best) + math.log10(_WALKS))
        for start, cost in matches.get(end, ()):
            best[end] = min(best[end], best[start] + cost)
    block, times = _block_repeats(value)
    return min(best[-1], guess_cost(block) + math.log10(times)) if times > 1 else best[-1]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, leftmost and not overlapping within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _value_end(text: str, start: int, stop: int, quote: str) -> int:
    """Where the value from ``start`` ends, before ``stop``: at its closing quote, or at a delimiter that a key follows."""
    if quote:
        closing = _CLOSING[quote].search(text, start, stop)
        if closing:
            return closing.start()
    for found in _DELIMITERS.finditer(text, start, stop):
        if _ENDING.isdisjoint(found[0]):
            continue
        if _KEY.match(text, found.end()) or (found[0][-1] == ";" and _LONG_KEY.match(text, found.end())):
            return found.start()
    return stop


def added_spans(text: str, base: list[tuple[int, int, int]], limit: float = COST_LIMIT) -> list[tuple[int, int, int]]:
    """Credential values, or what of them lies outside the base spans, that are costly to guess.

    A value reaches to the next blank or credential word at most; a quoted one to its closing quote; any other to a
    quote, comma, semicolon, ampersand or brace that a key follows.
    """
    out = []
    covered: list[list[int]] = []  # the base spans' union
    for start, _, end in base:
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(end, covered[-1][1])
        else:
            covered.append([start, end])
    heads = list(CONTEXT.finditer(text))
    at = 0
    for head, following in zip(heads, [*(m.start() for m in heads[1:]), len(text)]):
        start = head.end()
        end = _value_end(text, start, _RUN.match(text, start, following).end(), head[1])
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        while start < end:
            low, high = covered[at] if at < len(covered) else (end, end)
            stop = start + len(text[start : min(low, end)].rstrip(_TRIM))
            if stop - start >= LEAST_LENGTH and guess_cost(text[start:stop]) >= limit:
                out.append((start, 3, stop))
            if low >= end or high >= end:
                break
            start, at = high, at + 1
    return out


def _scan(texts: pa.Array) -> pa.Array:
    rows = []
    for text in texts.to_pylist():
        base = base_spans(text) if text else []
        added = added_spans(text, base) if text else []
        rows.append(
            {
                name: [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]
                for name, spans in (("base", base), ("added", added))
            }
        )
    return pa.array(rows, _SCAN_ARROW)


def scan_secrets(docs: DataFrame, text: str = "text", output: str = "secrets") -> DataFrame:
    """Adds one struct column with the base spans and the added ones, each ordered by start, then kind."""
    return docs.withColumn(output, F.arrow_udf(_scan, SCAN)(plain(text).cast("string")))


def _mask(texts: pa.Array, scans: pa.Array) -> pa.Array:
    out = []
    for text, scan in zip(texts.to_pylist(), scans.to_pylist()):
        if text:
            kept, at = [], 0
            for span in sorted((*scan["base"], *scan["added"]), key=lambda s: (s["start"], s["end"])):
                if span["start"] >= at:
                    kept += [text[at : span["start"]], "<SECRET>"]
                at = max(at, span["end"])
            text = "".join([*kept, text[at:]])
        out.append(text)
    return pa.array(out, pa.string())


def mask_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """All documents, each run of overlapping spans replaced by one mark; NULL stays NULL."""
    scanned = scan_secrets(docs, text, "__secrets")
    masked = F.arrow_udf(_mask, T.StringType())(plain(text).cast("string"), F.col("__secrets"))
    return scanned.withColumn(text, masked).drop("__secrets")
