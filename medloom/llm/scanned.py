"""Text of scanned pages repaired into continuous paragraphs.

Furniture: lines at a page's edges whose digits are masked.  A masked line is
a running header or footer if it comes again on other pages of its text, or
stands at edges more often than chance puts a line there and never inside
pages; a lone number is one if it counts the pages.  The outer two lines of a
page are asked, and a further one as long as all lines outside it are
furniture: headers may have any number of lines.

Words: every word is written as a skeleton of strokes in which confusable
glyphs agree (``m`` and ``rn``, ``d`` and ``cl``, ``l`` and ``1`` and ``!``).
Within a skeleton the frequent form stands and rare ones are misread; where
frequencies don't decide, the form that the neighbouring words support does.
A rare word that two frequent words make, side by side in the corpus, has lost
its space.  A break sign at a line's end belongs to the word only if the
corpus writes the word with it.

Every text is read four times as a whole, by Arrow batches: for the lines at
page edges and the broken words; for counts of words and of asked lines; for
neighbours; for the words found misread.  Different words, lines and
pairs of a batch are found by Arrow's functions, and only these are looked at
one by one.  Only counts, keys and the lines asked for leave a pass.  What a pass asks for is named by a bit filter of bounded size;
what slips through the filter is taken out by an exact join, so the filter
never decides.  Texts that come again are counted and judged once.

Defined results: null and empty texts have no lines; page markers and blank
lines are never noise; texts without markers have no furniture; a text that
comes again under another key has the same rows under each of its keys.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from medloom.session import BROADCAST_LIMIT, materialize

MARKER = r"^--- Page (\d+) ---$"
SHY, NOT_SIGN = chr(0xAD), chr(0xAC)
#: Break signs at a line's end.
SIGNS = f"-{SHY}{NOT_SIGN}{chr(0x2010)}"
BREAK = f"[{SIGNS}]"
#: How many times more often than a misread form the right one comes.
RATIO = 6
#: The share that a misread form may have, one occurrence of each side added beforehand.
SHARE = 0.25
#: Occurrences a form needs before its neighbours can tell that it is a word of its own.
PRIOR = 5
#: Lines at each edge of a page that are asked at first.
DEPTH = 3
#: Most bits of a filter.
FILTER_BITS = 1 << 26
#: Bytes of text that a pass takes at a time; a longer text is taken by itself.
PART_BYTES = 1 << 25


def skeleton(word: Column) -> Column:
    """Strokes of a word; each letter is replaced on its own, so joined and split glyphs agree."""
    plain = F.translate(F.lower(word), "áàâäãåéèêëíìîïóòôöõúùûüñç", "aaaaaaeeeeiiiiooooouuuunc")
    one = F.translate(plain, "i1!|r0e5fq9", "lllllocstgg")
    out = one
    for glyph, strokes in STROKES:
        out = F.replace(out, F.lit(glyph), F.lit(strokes))
    return out


#: Glyphs that scans part in two.
STROKES = (("m", "ln"), ("d", "cl"), ("u", "ll"), ("h", "ll"), ("b", "ll"), ("6", "ll"), ("w", "vv"))
_ONE = str.maketrans("áàâäãåéèêëíìîïóòôöõúùûüñçi1!|r0e5fq9", "aaaaaaeeeeiiiiooooouuuunclllllocstgg".replace("i", "l").replace("e", "c"))
_SIDE = re.compile(r"^\d{1,4}\s{2,}(?=\S)|(?<=\S)\s{2,}\d{1,4}$")
_NUMBER = re.compile(r"(?<!\S)[^\sA-Za-z]*[A-Za-z]?[^\sA-Za-z]*\d[^\sA-Za-z]*(?!\S)")


class _Masked(dict):
    """A word's skeleton, or ``#`` for a number; each word is written once."""

    def __missing__(self, word: str) -> str:
        out = "#" if _NUMBER.fullmatch(word) else word.lower().translate(_ONE)
        for glyph, strokes in STROKES:
            out = out.replace(glyph, strokes)
        self[word] = out
        return out


def masked(line: str, known: _Masked) -> list[str]:
    """Words of a line without its page number at a side, numbers masked, in skeletons."""
    line = line.strip()
    if line[:1].isdecimal() or line[-1:].isdecimal():
        line = _SIDE.sub("", line)
    return [known[w] for w in line.split()]


# --- passes over whole texts ---------------------------------------------


def _pass(docs: DataFrame, work: Callable[[pa.Array, pa.Array], pa.RecordBatch], schema: str) -> DataFrame:
    """Run ``work(docs, texts)`` on every Arrow batch of (doc, text), in parts of ``PART_BYTES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = np.cumsum(pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64) // PART_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]
            for i, j in zip(cuts, cuts[1:]):
                yield work(b.column(0).slice(i, j - i), b.column(1).slice(i, j - i))

    return docs.select("doc", "text").mapInArrow(run, schema)


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([c.cast(kinds[k]) if isinstance(c, pa.Array) else pa.array(c, type=kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _signed(hashes: list[int]) -> np.ndarray:
    return np.array(hashes, dtype=np.uint64).view(np.int64)


_h = xxhash.xxh3_64_intdigest
_MARK = re.compile(r"^--- Page \d+ ---$")


_BLANK = " \t\r\f\v"
_EDGE_BYTES = _BLANK.encode()


def pages(text: str) -> list[list[tuple[int, str]]]:
    """The lines (number, line) of each page that are neither blank nor markers; those before the first marker come first."""
    out: list[list[tuple[int, str]]] = [[]]
    here = out[0]
    for i, line in enumerate(text.split("\n"), 1):
        if line and not line.isspace():
            if line[-1] in _BLANK:
                line = line.rstrip(_BLANK)
            if line[0] == "-" and _MARK.match(line):
                here = []
                out.append(here)
            else:
                here.append((i, line))
    return out


#: Digits of a plain key agree.
_PLAIN = bytes(ord("#") if chr(c) in "0123456789" else c for c in range(256))


def _plain_keys(line: bytes) -> tuple[int, int]:
    """Keys of a line, and of its last two words (0 where it has no more), with digits masked."""
    tail = line.rsplit(None, 2)
    return _h(line), _h(b"\x00" + tail[1] + b" " + tail[2]) if len(tail) == 3 else 0


def _plain(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace").translate(_PLAIN)


_LONE = re.compile(r"^[\dlI!Oo\s]*\d[\dlI!Oo\s]*$")
_AS_DIGIT = str.maketrans("lI!Oo", "11100")
_ENDS = re.compile(rf"[^\W_]{BREAK}$|!{BREAK}$")


def _going_on(parted: list[list[tuple[int, str]]], page: int, at: int, depth: int) -> Iterator[tuple[int, str]]:
    """The lines behind one, up to the first that is further than ``depth`` from a page's edges."""
    for k in range(page, len(parted)):
        n = len(parted[k])
        for i in range(at + 1 if k == page else 0, n):
            yield parted[k][i]
            if not k or min(i + 1, n - i) > depth:
                return


EDGE = "doc long, no int, page int, top int, bottom int, key long, tail long, h_key long, h_tail long, lone long, word string, next_no int, next_first string"


def edges(docs: DataFrame, depth: int) -> DataFrame:
    """Rows of two kinds, told apart by ``page``.

    With a page: (doc, no, page, top, bottom, key, tail, h_key, h_tail, lone),
    the lines within ``depth`` of a page's edges.  ``key`` stands for the
    masked line and ``tail`` for its last two words (0 where it has no more),
    ``h_key`` and ``h_tail`` for the plain writing, ``lone`` is the number
    where the line is nothing else.

    Without: (doc, no, word, next_no, next_first), the last word of every line
    that ends in a break sign with the first word of each line that may go on:
    those up to the first one that no furniture within ``depth`` reaches.
    """

    def work(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        out: list[tuple] = []
        keys: list[int] = []
        known: dict[str, tuple] = {}
        skeletons = _Masked()
        for doc, text in zip(ids.to_pylist(), texts.to_pylist()):
            parted = pages(text)
            for page, lines in enumerate(parted[1:], 1):
                n = len(lines)
                for i in range(n) if n <= 2 * depth else (*range(depth), *range(n - depth, n)):
                    no, line = lines[i]
                    if line not in known:
                        words = masked(line, skeletons)
                        lone = "".join(line.split()).translate(_AS_DIGIT) if _LONE.match(line) else ""
                        tail = _h(" ".join(words[-2:])) if len(words) > 2 else 0
                        known[line] = (_h("".join(words)), tail, *_plain_keys(_plain(line).strip(_EDGE_BYTES))), int(lone) if lone and len(lone) < 10 else None
                    k, lone = known[line]
                    keys += k
                    out.append((doc, no, page, i + 1, n - i, lone, None, None, None))
            for k, lines in enumerate(parted):
                for i, (no, line) in enumerate(lines):
                    if line[-1] in SIGNS and _ENDS.search(line):
                        last = line.rsplit(None, 1)[-1]
                        for next_no, after in _going_on(parted, k, i, depth):
                            keys += (0, 0, 0, 0)
                            out.append((doc, no, None, None, None, None, last, next_no, after.split(None, 1)[0]))
        doc, no, page, top, bottom, lone, word, next_no, first = zip(*out) if out else [[]] * 9
        k = _signed(keys).reshape(-1, 4)
        return _batch(EDGE, [doc, no, page, top, bottom, k[:, 0], k[:, 1], k[:, 2], k[:, 3], lone, word, next_no, first])

    return _pass(docs, work, EDGE)


class Filter:
    """A set of keys as bits: nothing asked for is missed; other keys may pass."""

    def __init__(self, keys: DataFrame) -> None:
        """``keys`` has one BIGINT column; the bits, at most ``FILTER_BITS``, are set by the executors."""
        keys = keys.toDF("k").where("k IS NOT NULL")
        n = keys.count()
        self.size = min(FILTER_BITS, max(1 << 15, 1 << (16 * n).bit_length()))
        at = keys.select(F.col("k").bitwiseAND(F.lit(self.size - 1)).alias("p")).select(F.expr("p div 32768").alias("part"), (F.col("p") % 32768).alias("bit"))
        bits = np.zeros(self.size // 8, dtype=np.uint8)
        for r in at.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("m")).collect() if n else []:
            bits[r.part * 4096 : r.part * 4096 + 4096] = np.frombuffer(bytes(r.m), dtype=np.uint8)
        self.bits = bits.tobytes()

    def __contains__(self, key: int) -> bool:
        p = key & (self.size - 1)
        return bool(self.bits[p >> 3] >> (p & 7) & 1)

    def passed(self, keys: np.ndarray) -> np.ndarray:
        """Which of the keys pass."""
        p = keys & (self.size - 1)
        return (np.frombuffer(self.bits, dtype=np.uint8)[p >> 3] >> (p & 7)) & 1 == 1


def _crc(*words: str) -> int:
    return zlib.crc32(" ".join(words).encode("utf-8", "replace"))


def crc(*words: Column) -> Column:
    """The same key in an expression."""
    return F.crc32(F.concat_ws(" ", *words).cast("binary"))


#: A word broken at a line's end and the line end, for RE2; the class behind it is the white space of ``str.split``.
_BROKEN = rf"{BREAK}[ \t\r]*\n[\t-\r\x1c-\x1f\x{{85}}\p{{Z}}]*"
COUNT = "token string, line long, n long"


def _joined(texts: pa.Array) -> pa.Array:
    """The texts with each broken word in one, marked by a sign of its own."""
    return pc.replace_substring_regex(texts, _BROKEN, "\x01")


#: White space of ``str.split``: single bytes become blanks by a table, the rest by an expression.
_TO_BLANK = bytes(32 if c < 128 and chr(c).isspace() else c for c in range(256))
_WIDE = "[" + "".join(c for c in map(chr, range(128, 0x3001)) if c.isspace()) + "]"


def _translated(rows: pa.Array, table: bytes) -> pa.Array:
    """Rows of an array of its own (not a slice) with their bytes replaced."""
    valid, ends, data = rows.buffers()
    return pa.Array.from_buffers(rows.type, len(rows), [valid, ends, pa.py_buffer(data.to_pybytes().translate(table))]) if data else rows


def _tokens(rows: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(different words, the word at every place, its row), parted as ``str.split`` does.

    Arrow's own split at white space leaves some of it at a row's end in the last word.
    """
    parted = pc.split_pattern(_translated(pc.replace_substring_regex(rows, _WIDE, " "), _TO_BLANK), " ")
    coded = parted.flatten().dictionary_encode()
    words, at, row = coded.dictionary, coded.indices.to_numpy(), np.repeat(np.arange(len(parted)), np.diff(parted.offsets.to_numpy()))
    empty = pc.index(words, "").as_py()  # stands between two blanks and at a row's ends
    return (words, at, row) if empty < 0 else (words, at[at != empty], row[at != empty])


def counts(docs: DataFrame, asked: Filter) -> DataFrame:
    """(token, line, n): how often the texts have each word, not counting broken ones, and each asked line (by its plain keys)."""

    def work(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        words, at, _ = _tokens(_joined(texts))
        whole = [(w, c) for w, c in zip(words.to_pylist(), np.bincount(at, minlength=len(words)).tolist()) if c and "\x01" not in w]
        lines = _translated(pc.split_pattern(texts, "\n").flatten(), _PLAIN).dictionary_encode()  # many differ in digits only
        keys: list[int] = []
        times: list[int] = []
        for line, n in zip(_plain("\n".join(lines.dictionary.to_pylist())).split(b"\n"), np.bincount(lines.indices.to_numpy()).tolist()):
            line = line.strip(_EDGE_BYTES)
            if line:
                keys += _plain_keys(line)
                times += (n, n)
        hashed = _signed(keys)
        passed = asked.passed(hashed)
        some, back = np.unique(hashed[passed], return_inverse=True)
        n = np.zeros(len(some), dtype=np.int64)
        np.add.at(n, back, np.array(times, dtype=np.int64)[passed])
        return _batch(COUNT, [[w for w, _ in whole] + [None] * len(some), [None] * len(whole) + some.tolist(), [c for _, c in whole] + n.tolist()])

    return _pass(docs, work, COUNT)


#: Punctuation round a word.
OPENING, CLOSING = "([\"“‘„*", ".,;:)]\"”’'?*"


def _form(token: str) -> str:
    return token.lstrip(OPENING).rstrip(CLOSING).lower()


def form(token: Column) -> Column:
    """A token without the punctuation round it, in lower case."""
    return F.lower(F.rtrim(F.ltrim(token, F.lit(OPENING)), F.lit(CLOSING)))


NEAR = "a string, b string, n long"


def neighbours(docs: DataFrame, pairs: Filter, contested: Filter) -> DataFrame:
    """(a, b, n): how often asked pairs stand side by side, and what stands to the left of asked words."""

    def work(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        words, at, row = _tokens(_joined(texts))
        known: dict[str, int] = {}
        at = np.array([known.setdefault(_form(w), len(known)) for w in words.to_pylist()], dtype=np.int64)[at]
        two, n = np.unique((at[:-1] * len(known) + at[1:])[row[:-1] == row[1:]], return_counts=True)
        forms, of = list(known), [_crc(f) in contested for f in known]
        out = [(forms[a], forms[b], m) for a, b, m in zip((two // max(1, len(forms))).tolist(), (two % max(1, len(forms))).tolist(), n.tolist()) if of[b] or _crc(forms[a], forms[b]) in pairs]
        return _batch(NEAR, list(zip(*out)) if out else [[]] * 3)

    return _pass(docs, work, NEAR)


SEEN = "doc long, no int, token string, at_start boolean, at_end boolean"


def seen_tokens(docs: DataFrame, asked: Filter) -> DataFrame:
    """(doc, no, token, at_start, at_end): every asked token with its place in its line."""

    def work(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        lines = pc.split_pattern(texts, "\n")
        words, at, row = _tokens(lines.flatten())
        some = np.flatnonzero(np.array([_crc(w) in asked for w in words.to_pylist()], dtype=bool)[at])
        turn = np.concatenate([[True], row[1:] != row[:-1], [True]])
        first = lines.offsets.to_numpy()
        doc = np.searchsorted(first, row[some], side="right") - 1
        return _batch(SEEN, [ids.take(pa.array(doc)), row[some] - first[doc] + 1, words.take(pa.array(at[some])), turn[:-1][some], turn[1:][some]])

    return _pass(docs, work, SEEN)


def _within(df: DataFrame, bytes_a_row: int = 64) -> DataFrame:
    """Broadcast behind a count of its rows of ``bytes_a_row`` at most; above the limit the join is shuffled."""
    return F.broadcast(df) if df.count() * bytes_a_row <= BROADCAST_LIMIT else df


def distinct_texts(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """((doc, text) of the first row of every text, (doc, key) of the other rows of that text)."""
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    hashed = materialize(rows.select("key", F.md5(F.col("text").cast("binary")).alias("h")))
    again = hashed.groupBy("h").agg(F.min("key").alias("doc"), F.count("*").alias("n")).where("n > 1").select("h", "doc")
    copies = materialize(hashed.join(again, "h").where("key <> doc").select("doc", "key").distinct())
    return rows.join(_within(copies.select("key").distinct()), "key", "left_anti").select(F.col("key").alias("doc"), "text"), copies


def for_copies(found: DataFrame, copies: DataFrame) -> DataFrame:
    """The rows of ``doc`` once more for each other key of its text."""
    found = materialize(found)  # it is read twice
    more = found.join(_within(copies), "doc").select(F.col("key").alias("doc"), *[c for c in found.columns if c != "doc"])
    return found.unionByName(more)


def lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, no, line, page, top, bottom): the lines that are neither blank nor markers.

    ``top`` and ``bottom`` count the page's lines from both ends, from 1.  A
    text's lines stay in its row until they are exploded: nothing is shuffled.
    """
    # markers cut the text into pages; a page's first line number follows from the line ends before it
    parts = F.split(text, r"(?m)^--- Page \d+ ---[ \t\r]*$")
    cut = docs.select(F.col(key).alias("doc"), parts.alias("parts"), F.transform(parts, lambda p: F.length(p) - F.length(F.replace(p, F.lit("\n"), F.lit("")))).alias("ends"))
    paged = cut.select("doc", F.posexplode(F.transform("parts", lambda p, k: F.struct(p.alias("p"), F.aggregate(F.slice("ends", 1, k), F.lit(0), lambda s, e: s + e).alias("before")))).alias("page", "x"))
    numbered = F.transform(F.split("x.p", "\n"), lambda l, i: F.struct((F.col("x.before") + i + 1).alias("no"), F.rtrim(l, F.lit(" \r\t")).alias("line")))
    some = paged.select("doc", "page", F.filter(numbered, lambda l: F.ltrim(l["line"]) != "").alias("some"))
    each = some.select("doc", "page", F.size("some").alias("n"), F.posexplode("some").alias("i", "l"))
    return each.select("doc", "l.no", "l.line", F.when(F.col("page") > 0, F.col("page")).alias("page"), (F.col("i") + 1).alias("top"), (F.col("n") - F.col("i")).alias("bottom"))


def _asked(keyed: DataFrame, key: str) -> DataFrame:
    """(key, doc, pages, n, outer) of lines at edges: on how many pages of a text a line stands near an edge."""
    some = keyed.where(f"{key} <> 0").groupBy(key, "doc").agg(F.count("*").alias("n"), F.count_if("outer").alias("outer"), F.size(F.collect_set("page")).alias("pages"))
    return materialize(some)


def _inside(keyed: DataFrame, key: str, stats: DataFrame, lines: DataFrame) -> DataFrame:
    """``stats`` with ``inside``: how often their lines stand elsewhere, over all writings of a masked key."""
    writings = keyed.join(_within(stats.select(key)), key, "left_semi").groupBy(key, F.col(f"h_{key}").alias("line")).agg(F.count("*").alias("e"))
    inside = writings.join(lines, "line").groupBy(key).agg(F.sum(F.greatest(F.col("n") - F.col("e"), F.lit(0))).alias("inside"))
    return stats.join(inside, key, "left").fillna(0, ["inside"])


def furniture(docs: DataFrame, depth: int = DEPTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """((doc, no) of the running headers, footers and page numbers, (token, n) of all words, the broken lines).

    A line stands at edges by more than chance if it does so as often as no
    line would that has its places at random: fewer than one of all the
    different lines is expected to.  So the occurrences it takes follow from
    the share of lines that stand at edges and grow with the logarithm of the
    corpus only.
    """
    near = F.least("top", "bottom") <= 2
    both = materialize(edges(docs, depth))
    broken = both.where("page IS NULL").select("doc", "no", F.col("word").alias("line"), "next_no", "next_first")
    every = both.where("page IS NOT NULL").drop("word", "next_no", "next_first").withColumn("outer", (F.col("top") == 1) | (F.col("bottom") == 1))
    keyed = every.where(near)
    by_key, by_tail = _asked(keyed, "key"), _asked(keyed, "tail")
    size = every.agg(F.sum(F.when(F.col("top") == 1, F.col("top") + F.col("bottom") - 1)).alias("lines"), F.count_if(near).alias("near")).first()
    stats = {k: materialize(df.groupBy(k).agg(F.sum("n").alias("e"), F.sum("outer").alias("outer"), F.max("pages").alias("pages"))) for k, df in (("key", by_key), ("tail", by_tail))}

    def least(different: int) -> float:
        share = min(0.999, (size.near or 0) / max(1, size.lines or 0))
        return max(2.0, math.log(max(1, different)) / -math.log(share)) if share else 2.0

    often = {k: least(df.count()) for k, df in stats.items()}
    asked = {k: df.where((F.col("e") >= often[k]) | (F.lit(k == "key") & (F.col("pages") >= 2))) for k, df in stats.items()}
    deeper = every.where(~near)
    inner = deeper.groupBy("key").agg(F.count("*").alias("e")).where("e >= 2").select("key")
    asked = {k: materialize(df) for k, df in asked.items()}
    wanted = [keyed.join(_within(asked[k].select(k)), k, "left_semi").select(F.col(f"h_{k}").alias("k")).distinct() for k in stats] + [deeper.join(_within(inner), "key", "left_semi").select(F.col("h_key").alias("k")).distinct()]
    counted = materialize(counts(docs, Filter(materialize(wanted[0].unionByName(wanted[1]).unionByName(wanted[2])))))
    lines = materialize(counted.where("line IS NOT NULL").groupBy("line").agg(F.sum("n").alias("n")))
    words = materialize(counted.where("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n")))

    keys, tails = materialize(_inside(keyed, "key", asked["key"], lines)), _inside(keyed, "tail", asked["tail"], lines)
    never = keys.where((F.col("e") >= often["key"]) & (F.col("inside") * 50 <= F.col("e"))).select("key")
    ending = tails.where((F.col("e") >= often["tail"]) & (F.col("inside") * 50 <= F.col("e")) & (F.col("outer") * 2 >= F.col("e"))).select("tail")
    again = by_key.where("pages >= 2").join(keys.where("inside * 5 <= e").select("key"), "key", "left_semi").select("key", "doc")
    lone = keyed.where("outer AND lone IS NOT NULL")
    series = ["doc", (F.col("lone") - F.col("page")).alias("s"), (F.col("top") == 1).alias("t")]
    counting = lone.select(*series).groupBy("doc", "s", "t").agg(F.count("*").alias("c")).where("c >= 2")
    place = ["doc", "no", "page", "top", "bottom"]
    small = lambda df: _within(materialize(df))
    parts = [
        keyed.join(small(never), "key", "left_semi"), keyed.where("outer").join(small(ending), "tail", "left_semi"), keyed.where("lone IS NULL OR NOT outer").join(small(again), ["key", "doc"], "left_semi"),
        lone.withColumn("s", series[1]).withColumn("t", series[2]).join(small(counting), ["doc", "s", "t"], "left_semi"),
    ]
    drop = parts[0].select(*place)
    for p in parts[1:]:
        drop = drop.unionByName(p.select(*place))
    drop = materialize(drop.distinct())
    deepest = 2
    for d in range(3, depth + 1):
        # a line further in is asked where all lines outside it are furniture
        exposed = deeper.where(F.col("top") == d).join(drop.where(F.col("top") == d - 1).select("doc", "page"), ["doc", "page"], "left_semi")
        exposed = exposed.unionByName(deeper.where(F.col("bottom") == d).join(drop.where(F.col("bottom") == d - 1).select("doc", "page"), ["doc", "page"], "left_semi"))
        exposed = materialize(exposed)
        by = exposed.groupBy("key", "doc").agg(F.count("*").alias("n"), F.size(F.collect_set("page")).alias("pages")).groupBy("key").agg(F.sum("n").alias("e"), F.max("pages").alias("pages"))
        some = _inside(exposed, "key", by.where("e >= 2"), lines)
        more = some.where(((F.col("e") >= often["key"]) & (F.col("inside") * 50 <= F.col("e"))) | ((F.col("pages") >= 2) & (F.col("inside") * 5 <= F.col("e")))).select("key")
        more = materialize(exposed.where("lone IS NULL").join(more, "key", "left_semi").select(*place).distinct())
        if not more.count():
            break
        drop, deepest = materialize(drop.unionByName(more)), d
    if deepest == depth:
        return furniture(docs, 2 * depth)
    return drop.select("doc", "no").distinct(), words, broken


#: Codes of upper-case letters and digits, and bare numbers with signs, are no words to repair.
CODE = r"^(?=.*[A-Z].*[A-Z\d])[A-Z\d/-]+$"
_WORD = r"^[\p{L}\d!|'’-]*\p{L}[\p{L}\d!|'’-]*$"


def judged_forms(counts: DataFrame) -> DataFrame:
    """(form, n, best, n_best, is_misread) of every form, by the forms that share its skeleton.

    A form gives way to one that comes ``RATIO`` times as often and leaves it a
    share of at most ``SHARE``.
    """
    letters = F.length(F.regexp_replace("form", r"[^\p{L}]", ""))
    other = F.length(F.regexp_replace("form", r"[^\d]", ""))
    word = counts.where(F.col("form").rlike(_WORD) & (letters >= 3)).withColumn("skel", skeleton(F.col("form")))
    clean = ~F.col("form").rlike(r"[!|]|\p{L}\d|\d\p{L}")
    best = word.groupBy("skel").agg(F.max_by("form", F.struct("n", "form")).alias("best"), F.max("n").alias("n_best"), F.sum("n").alias("n_all"), F.max(F.struct(clean.alias("c"), "n", "form"))["form"].alias("best_clean"), F.max(F.when(clean, F.col("n")).otherwise(0)).alias("n_clean"))
    out = word.join(best, "skel")
    broken = F.col("form").rlike(r"\p{Ll}[\d!|]+\p{Ll}|^[!|]\p{L}|\p{L}{3}!$|\p{Ll}{4,}\d$") & (letters > 2 * other)
    share = (F.col("n") + 1) / (F.col("n") + F.col("n_best") + 2)
    rarer = (F.col("form") != F.col("best")) & (F.col("n_best") >= RATIO * F.col("n")) & (share <= SHARE)
    # a sign inside a word is odd by itself, unless the form is far the most usual one of its strokes
    odd = ~clean & broken & ((F.col("n_clean") >= F.col("n")) | (F.col("form") == F.col("best")) & (F.col("n") < PRIOR))
    contested = rarer & clean & (F.col("n") > PRIOR) & F.col("form").rlike("^[a-z]+$")
    return out.select("form", "n", F.when(rarer, F.col("best")).when(odd & (F.col("n_clean") > 0), F.col("best_clean")).otherwise(F.col("form")).alias("best"), "n_best", (rarer | odd).alias("is_misread"), contested.alias("contested"), "skel", "n_all")


def split_candidates(rare: DataFrame, counts: DataFrame) -> DataFrame:
    """(form, n, a, b): ways to part rare forms into two words that are much more frequent by themselves."""
    share = lambda n: (F.col("n") + 1) / (F.col("n") + F.col(n) + 2)
    known = counts.where(F.col("form").rlike(r"^[\p{L}\d-]+$"))
    cut = rare.where(F.col("form").rlike(r"^[\p{L}\d-]+$") & (F.length("form") >= 4)).select("form", "n", F.explode(F.sequence(F.lit(1), F.length("form") - 1)).alias("i"))
    halves = cut.select("form", "n", F.expr("substring(form, 1, i)").alias("a"), F.expr("substring(form, i + 1)").alias("b"))
    first, second = known.select(F.col("form").alias("a"), F.col("n").alias("n_a")), known.select(F.col("form").alias("b"), F.col("n").alias("n_b"))
    often = lambda n: (F.col(n) >= RATIO * F.col("n")) & (share(n) <= SHARE / RATIO)
    return halves.join(first, "a").where(often("n_a")).join(second, "b").where(often("n_b")).select("form", "n", "a", "b")


def breaks(rows: DataFrame, forms: DataFrame) -> DataFrame:
    """Lines that end inside a word: (doc, no, next_no, sign, head, tail, joined, linked, best, belongs)."""
    word = F.col("line")
    ends = rows.select("doc", "no", "next_no", F.right(word, F.lit(1)).alias("sign"), form(F.substring(word, F.lit(1), F.length(word) - 1)).alias("head"), form(F.col("next_first")).alias("tail"))
    ends = ends.withColumn("joined", F.concat("head", "tail")).withColumn("linked", F.concat("head", F.lit("-"), "tail"))
    by = forms.groupBy("skel").agg(F.max("n_all").alias("n"), F.max_by("best", "n").alias("best"))
    by_j = by.select(F.col("skel").alias("sj"), F.col("n").alias("nj"), F.col("best").alias("best_joined"))
    by_l = by.select(F.col("skel").alias("sl"), F.col("n").alias("nl"), F.col("best").alias("best_linked"))
    # the same broken words come again and again: each is looked up once
    pairs = ends.select("joined", "linked").distinct().withColumn("sj", skeleton(F.col("joined"))).withColumn("sl", skeleton(F.col("linked"))).join(by_j, "sj", "left").join(by_l, "sl", "left")
    found = ends.join(pairs, ["joined", "linked"])
    nj, nl = F.coalesce("nj", F.lit(0)), F.coalesce("nl", F.lit(0))
    number = F.col("head").rlike(r"\d$")
    belongs = (F.col("sign") == "-") & ((nl > nj) | ((nl == nj) & number))
    return found.select("doc", "no", "next_no", "sign", "head", "tail", "joined", "linked", F.when(belongs, F.col("best_linked")).otherwise(F.col("best_joined")).alias("best"), belongs.alias("belongs"))


def analysed(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(furniture, misread forms with their right form, broken words, all tokens with their form) of distinct texts."""
    drop, words, cut = furniture(docs)
    drop = materialize(drop)
    bare = F.rtrim(F.ltrim("token", F.lit(OPENING)), F.lit(CLOSING))
    tokens = words.where((bare != "") & ~bare.rlike(CODE)).select("token", form(F.col("token")).alias("form"), "n")
    counts = materialize(tokens.groupBy("form").agg(F.sum("n").alias("n")))
    forms = materialize(judged_forms(counts))
    cut = cut.join(drop, ["doc", "no"], "left_anti").join(drop.select("doc", F.col("no").alias("next_no")), ["doc", "next_no"], "left_anti")
    cut = cut.groupBy("doc", "no").agg(F.min("line").alias("line"), F.min(F.struct("next_no", "next_first")).alias("x")).select("doc", "no", "line", "x.next_no", "x.next_first")
    ends = materialize(breaks(cut.where(F.col("next_first").rlike(r"^[\p{L}\d!(]")), forms))
    # rare forms, and broken words that are known neither joined nor linked, may hold a lost space
    good = counts.join(forms.where("is_misread").select("form"), "form", "left_anti")
    unknown = ends.where("best IS NULL").select(F.explode(F.array("joined", "linked")).alias("form")).distinct().join(counts, "form", "left_anti").withColumn("n", F.lit(0).cast("bigint"))
    parts = materialize(split_candidates(good.unionByName(unknown.select("form", "n")), good))
    contested = forms.where("contested").select("form", "best")
    ask = materialize(contested.select(F.col("form").alias("w"), F.col("form").alias("owner"), F.lit(True).alias("own")).unionByName(contested.select(F.col("best").alias("w"), F.col("form").alias("owner"), F.lit(False).alias("own"))))
    seen = neighbours(docs, Filter(parts.select(crc(F.col("a"), F.col("b"))).distinct()), Filter(ask.select(crc(F.col("w"))).distinct()))
    seen = materialize(seen.groupBy("a", "b").agg(F.sum("n").alias("m")))
    spaces = parts.join(seen, ["a", "b"]).where(F.col("m") >= F.greatest(F.lit(2), 2 * F.col("n")))
    spaces = materialize(spaces.groupBy("form").agg(F.max_by(F.concat_ws(" ", "a", "b"), F.struct("m", "a")).alias("best")))
    near = seen.select(F.col("b").alias("w"), F.col("a").alias("l"), "m")
    misread = forms.where("is_misread").join(_own_words(ask, near), "form", "left_anti").select("form", "best")
    bad = misread.unionByName(spaces.join(counts, "form", "left_semi")).groupBy("form").agg(F.min("best").alias("best"))
    parted = spaces.join(counts, "form", "left_anti")
    whole = parted.select(F.col("form").alias("joined"), F.col("best").alias("pj")), parted.select(F.col("form").alias("linked"), F.col("best").alias("pl"))
    ends = ends.join(whole[0], "joined", "left").join(whole[1], "linked", "left")
    ends = ends.withColumn("spaced", F.col("best").isNull() & (F.col("pj").isNotNull() | F.col("pl").isNotNull()))
    ends = ends.withColumn("belongs", F.col("belongs") | (F.col("spaced") & F.col("pj").isNull())).withColumn("best", F.coalesce("best", "pj", "pl")).drop("pj", "pl")
    return drop, materialize(bad), materialize(ends), tokens


def _own_words(ask: DataFrame, near: DataFrame) -> DataFrame:
    """Contested forms whose left neighbours rarely come with the form they could stand for."""
    with_ = near.join(ask, "w")
    shared = with_.groupBy("owner", "l").agg(F.sum(F.when(F.col("own"), F.col("m"))).alias("mine"), F.sum(F.when(~F.col("own"), F.col("m"))).alias("theirs")).where("mine IS NOT NULL")
    with_theirs = F.sum(F.when(F.col("theirs") >= F.col("mine"), F.col("mine")).otherwise(0))
    support = shared.groupBy("owner").agg(((with_theirs + PRIOR) / (F.sum("mine") + PRIOR)).alias("support"))
    return support.where("support < 0.5").select(F.col("owner").alias("form"))


def noise_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, no, noise_kind) of every furniture, hyphen and misread line."""
    docs, copies = distinct_texts(docs, key, text)
    drop, bad, ends, tokens = analysed(docs)
    suspects = materialize(tokens.join(bad, "form", "left_semi").select("token"))
    seen = seen_tokens(docs, Filter(suspects.select(crc(F.col("token"))))).join(_within(suspects), "token", "left_semi")
    # a broken word is judged whole; its parts aren't words
    heads, conts = ends.select("doc", "no", F.lit(True).alias("at_end")), ends.select("doc", F.col("next_no").alias("no"), F.lit(True).alias("at_start"))
    misread = seen.join(heads, ["doc", "no", "at_end"], "left_anti").join(conts, ["doc", "no", "at_start"], "left_anti").join(drop, ["doc", "no"], "left_anti").select("doc", "no")
    # which side of a broken word differs from the form it stands for
    whole = ends.where("best IS NOT NULL").withColumn("seen", F.when(F.col("belongs"), F.col("linked")).otherwise(F.col("joined"))).where("seen <> best")
    in_head = whole.where(~F.col("best").startswith(F.col("head"))).select("doc", "no")
    in_tail = whole.where(F.col("spaced") | ~F.col("best").endswith(F.col("tail"))).select("doc", F.col("next_no").alias("no"))
    kinds = [
        drop.withColumn("noise_kind", F.lit("furniture")), ends.where(~F.col("belongs")).select("doc", "no", F.lit("hyphen").alias("noise_kind")),
        misread.unionByName(in_head).unionByName(in_tail).distinct().withColumn("noise_kind", F.lit("misread")),
    ]
    return for_copies(kinds[0].unionByName(kinds[1]).unionByName(kinds[2]), copies)


def paragraphs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, paragraph_no, text): repaired lines joined to paragraphs, in order.

    A paragraph begins at an indented line, after a blank line inside a page,
    at a short line that has no sentence end, and where the line before ended
    a sentence well before the usual width.
    """
    docs, copies = distinct_texts(docs, key, text)
    drop, bad, ends, _ = analysed(docs)
    rows = lines(docs, "doc", "text").join(drop, ["doc", "no"], "left_anti").join(ends.select("doc", "no", "head"), ["doc", "no"], "left")
    bad = _within(bad)
    order = W.partitionBy("doc").orderBy("no")
    width = F.percentile_approx(F.length("line"), 0.9).over(W.partitionBy("doc"))
    before, before_no = F.lag("line").over(order), F.lag("no").over(order)
    same_page = F.lag("page").over(order).eqNullSafe(F.col("page"))
    ended = F.coalesce(before.rlike(r"[.!?:)”\"]$"), F.lit(True))
    starts = before.isNull() | F.col("line").startswith("  ") | (same_page & (F.col("no") - before_no > 1) & ended) | (ended & (F.length(before) < 0.6 * F.col("width"))) | (~before.rlike(r"[.,;\w]{2}$") & (F.length(before) < 0.4 * F.col("width"))) | (F.length(F.trim("line")) < 0.3 * F.col("width")) & ended
    numbered = rows.withColumn("width", width).withColumn("p", F.sum(F.coalesce(starts, F.lit(True)).cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    tokens = numbered.select("doc", "no", "p", "head", F.posexplode(F.split(F.ltrim("line"), r"\s+")).alias("k", "t"))
    fixed = tokens.withColumn("form", form(F.col("t"))).join(bad.withColumnRenamed("best", "right"), "form", "left")
    lead = F.regexp_extract("t", r"^([(\[\"“‘„*]*)", 1)
    trail = F.regexp_extract("t", r"([.,;:)\]\"”’'?*]*)$", 1)
    cased = F.when(F.ltrim("t", F.lit(OPENING)).rlike(r"^\p{Lu}"), F.concat(F.upper(F.substring("right", 1, 1)), F.expr("substring(right, 2)"))).otherwise(F.col("right"))
    word = F.when(F.col("right").isNull(), F.col("t")).otherwise(F.concat(lead, cased, trail))
    # words of one line are few; a paragraph's lines are joined in the order of (no, k)
    joined = fixed.groupBy("doc", "p", "no").agg(F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("k", word.alias("w")))), lambda x: x["w"])).alias("s"))
    with_end = joined.join(ends.select("doc", "no", "belongs"), ["doc", "no"], "left")
    piece = F.when(F.col("belongs").isNull(), F.concat("s", F.lit(" "))).when(F.col("belongs"), F.col("s")).otherwise(F.regexp_replace("s", rf"{BREAK}$", ""))
    out = with_end.groupBy("doc", "p").agg(F.trim(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("no", piece.alias("s")))), lambda x: x["s"]))).alias("text"))
    return for_copies(out, copies).select("doc", F.col("p").cast("int").alias("paragraph_no"), "text")
