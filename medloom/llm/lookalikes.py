"""Text that looks the same but differs in its characters, in one consistent form.

Each word that holds an odd character is run through a trie of the reference
vocabulary with a weighted edit automaton: ignorable characters, look-alikes
and compatibility forms cost nothing, other edits cost one.  A word that
reaches a vocabulary entry at no cost takes the entry's spelling in its own
case; a word within ``max_cost`` of one is meant in Latin letters, even if all
its letters come from another script.  Every other word is normalised by
table: compatibility forms, invisible characters, spaces and hyphens always,
look-alike letters only in words that mix scripts.

A vocabulary above ``MAX_WORDS`` is taken in parts of that size, one trie and
one pass over the odd texts after another; a word is done at its first hit.

Only texts with a character outside ASCII leave the JVM.

Defined results: null stays null, empty stays empty; words wholly in another
script, composed accents, Greek letters that name something, en dashes,
typographic quotes, superscripts and the degree sign stay as they are.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache, reduce

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.session import materialize

# Characters and the Latin letters they look like.
CYRILLIC = "АA ВB СC ЕE НH ІI ЈJ КK МM ОO РP ЅS ТT ХX УY аa сc еe һh іi јj оo рp ѕs хx уy ԁd ԛq ԝw ѵv ӏl"
GREEK = "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX αa ιi κk νv οo ρp υu χx ϳj"
LATIN = {p[0]: p[1] for p in f"{CYRILLIC} {GREEK}".split() if p[0] != p[1]}
#: Greek letters that name something (as a suffix or prefix of a name).
NAMING = "αβγδ"
HYPHENS = dict.fromkeys(map(chr, (0x2010, 0x2011, 0x2012, 0x2212, 0xFE63, 0xFE58, 0x2043)), "-")
# First and last code points of invisible characters, and of
# compatibility forms that stand in for ordinary characters of the same look.
INVISIBLE = [(0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200C), (0x200E, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0E), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xE0000, 0xE0FFF)]
FORMS = [(0xFF01, 0xFF9F), (0xFFE0, 0xFFE6), (0xFFE8, 0xFFEE), (0xFB00, 0xFB06), (0x1D400, 0x1D7FF), (0x2160, 0x217F), (0x2102, 0x2115), (0x2119, 0x211D), (0x2124, 0x2124), (0x212A, 0x2134), (0x24B6, 0x24E9)]


def _class(ranges: list[tuple[int, int]]) -> str:
    return "[" + "".join(f"{chr(lo)}-{chr(hi)}" for lo, hi in ranges) + "]"


_SPACES = regex.compile(r"[\p{Zs}\p{Zl}\p{Zp}\x85]")
#: A joiner or a selector after an emoji belongs to it.
_IGNORABLE = regex.compile(rf"(?<![\p{{So}}\p{{Sk}}{chr(0xFE0F)}])[{chr(0x200D)}{chr(0xFE0F)}]|{_class(INVISIBLE)}")
_FORMS = regex.compile(_class(FORMS))
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_LATIN, _OTHER = regex.compile(r"\p{Latin}"), regex.compile(r"[\p{Cyrillic}\p{Greek}]")
#: Words in letters, with the characters that scans and editors leave inside them.
_RAW = regex.compile(rf"[\p{{L}}\p{{N}}](?:[\p{{L}}\p{{M}}\p{{N}}{chr(0x200D)}]|{_class(INVISIBLE)})*")
_ODD = regex.compile(rf"[\p{{Cyrillic}}\p{{Greek}}\p{{M}}{chr(0x200D)}]|{_class(INVISIBLE)}|{_class(FORMS)}")
_NOTHING = regex.compile(rf"[{chr(0x200D)}{chr(0xFE0F)}]|{_class(INVISIBLE)}")
#: Most vocabulary words that one trie in an executor's memory holds.
MAX_WORDS = 200_000


def alike(c: str) -> set[str]:
    """What a character may stand for at no cost: itself, its look-alike, its compatibility form, or nothing."""
    out = {c, LATIN.get(c, c)}
    if _NOTHING.match(c):
        out.add("")
    if _FORMS.match(c):
        out.add(unicodedata.normalize("NFKC", c))
    return out


class Trie:
    """Words by their characters; ``find`` is the weighted edit automaton over them."""

    def __init__(self, words):
        self.root: dict = {}
        for w in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def find(self, word: str, max_cost: int = 1) -> tuple[int, str] | None:
        """(cost, entry) of the cheapest vocabulary entry, or None above ``max_cost``."""
        # states: trie node -> (cost, node); nodes are compared by identity
        states = {id(self.root): (0, self.root)}
        self._insertions(states, max_cost)
        for c in word:
            nxt: dict[int, tuple[int, dict]] = {}
            same = alike(c)
            for cost, node in states.values():
                for letters in same:  # one character may stand for several letters or none
                    at = node
                    for x in letters:
                        at = at.get(x) if at is not None else None
                    if at is not None:
                        _put(nxt, cost, at)
                if cost < max_cost:  # c is surplus or another letter
                    _put(nxt, cost + 1, node)
                    for label, child in node.items():
                        if label:
                            _put(nxt, cost + 1, child)
            self._insertions(nxt, max_cost)
            states = nxt
            if not states:
                return None
        ends = [(cost, node[""]) for cost, node in states.values() if "" in node]
        return min(ends) if ends else None

    @staticmethod
    def _insertions(states: dict, max_cost: int) -> None:
        todo = list(states.values())
        while todo:
            cost, node = todo.pop()
            if cost < max_cost:
                for label, child in node.items():
                    if label and _put(states, cost + 1, child):
                        todo.append((cost + 1, child))


def _put(states: dict, cost: int, node: dict) -> bool:
    old = states.get(id(node))
    if old is None or cost < old[0]:
        states[id(node)] = (cost, node)
        return True
    return False


def surface(text: str) -> str:
    """Compatibility forms, invisible characters, spaces and hyphens by table; letters stay."""
    kept = _SPACES.sub(" ", _IGNORABLE.sub("", text))
    kept = _FORMS.sub(lambda m: unicodedata.normalize("NFKC", m[0]), kept)
    return unicodedata.normalize("NFC", "".join(HYPHENS.get(c, c) for c in kept))


def _latin(word: str, keep: str = "") -> str:
    return "".join(c if c in keep else LATIN.get(c, c) for c in word)


def vocabulary_word(word: str, trie: Trie, max_cost: int = 1) -> str:
    """The spelling that the vocabulary gives a word with odd characters, or the word itself."""
    if word.isascii() or not _ODD.search(word):
        return word
    # composed where possible; what is invisible is left to the automaton
    raw = unicodedata.normalize("NFC", word)
    plain = _latin(surface(raw))
    if _OTHER.search(plain) or len(plain) < 2:
        return word  # letters of the other script beyond look-alikes: not meant in Latin
    ways = list(dict.fromkeys((raw, raw.lower(), raw.upper())))
    for way in ways:
        hit = trie.find(way, 0)
        if hit and hit[1].casefold() == plain.casefold():
            return _cased(hit[1], plain)
    scripts = _OTHER.search(raw) and not _LATIN.search(surface(raw))
    if scripts and len(plain) > 3 and any(trie.find(w, max_cost) for w in ways):
        return plain
    return word


def _cased(entry: str, like: str) -> str:
    """The entry's letters in the case of the word that stands for it."""
    if len(entry) != len(like):
        return like
    return "".join(e.upper() if x.isupper() else e.lower() if x.islower() else e for e, x in zip(entry, like, strict=True))


def table_word(word: str) -> str:
    """A word by table: look-alikes only where scripts are mixed; Greek letters that name something stand at its ends."""
    if word.isascii() or not _OTHER.search(word) or not _LATIN.search(word):
        return word
    inner = word.strip(NAMING)
    head, _, tail = word.partition(inner)
    return head + _latin(inner, NAMING) + tail


def by_trie(text: str | None, trie: Trie, max_cost: int = 1) -> str | None:
    """A text whose words that the vocabulary knows have its spelling."""
    if text is None or text.isascii() or not _ODD.search(text):
        return text
    return _RAW.sub(lambda m: vocabulary_word(m[0], trie, max_cost), text)


def by_table(text: str | None) -> str | None:
    """A text whose other characters are brought to one form; runs of plain spaces stay."""
    if text is None or text.isascii():
        return text
    text = surface(text)
    if not _OTHER.search(text):
        return text
    words = [m[0] for m in _WORD.finditer(text)]
    out = []
    for i, w in enumerate(words):
        c = table_word(w)
        if c == w and w not in NAMING and _OTHER.search(w) and not _OTHER.search(_latin(w)):
            # look-alikes only: another script needs a neighbour that is plainly of it
            near = [x for x in (*words[max(0, i - 1) : i], *words[i + 1 : i + 2])]
            if not any(_OTHER.search(_latin(x)) and not _LATIN.search(x) and x not in NAMING for x in near):
                c = _latin(w, NAMING)
        out.append(c)
    it = iter(out)
    return _WORD.sub(lambda m: next(it), text)


def canonical(text: str | None, trie: Trie | None = None, max_cost: int = 1) -> str | None:
    """One consistent form of a text: the vocabulary's spellings first, the table for the rest."""
    return by_table(text if trie is None else by_trie(text, trie, max_cost))


@lru_cache(1)
def _trie(words: frozenset) -> Trie:
    return Trie(words | {w.upper() for w in words})


def vocabulary(columns: list[DataFrame]) -> DataFrame:
    """(word) of reference lists: single-column frames of texts or arrays."""
    parts = []
    for df in columns:
        name, kind = df.dtypes[0]
        col = F.explode(name) if kind.startswith("array") else F.col(name)
        parts.append(df.select(col.alias("t")).select(F.explode(F.split(F.lower("t"), r"[^\p{L}\p{M}\p{N}]+")).alias("word")))
    return reduce(DataFrame.union, parts).where(F.length("word") > 1).distinct()


def parts_of(words: DataFrame, most: int) -> Iterator[list[str]]:
    """The vocabulary in lists of about ``most`` words at most, each small enough for the driver and a trie."""
    words = materialize(words)
    n = -(-words.count() * 10 // (9 * most))
    for i in range(n):
        yield sorted(r[0] for r in words.where(F.pmod(F.xxhash64("word"), F.lit(n)) == i).collect())


def _applied(text: Column, words: list[str], last: bool, max_cost: int) -> Column:
    """The trie of ``words`` and, at the ``last`` of them, the table; texts of ASCII characters never leave the JVM."""
    run = F.pandas_udf(_by(frozenset(words), last, max_cost), "string")
    plain = text.rlike(r"^[\x00-\x7f]*$")
    return F.when(plain | text.isNull(), text).otherwise(run(F.when(~plain, text)))


def _by(words: frozenset, last: bool, max_cost: int):
    def run(texts):
        trie = _trie(words) if words else None

        def one(t):
            t = t if trie is None else by_trie(t, trie, max_cost)
            return by_table(t) if last else t

        return texts.map(one, na_action="ignore")

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return run


def changed(text: Column, clean: Column) -> Column:
    """Whether anything but the number of plain spaces differs."""
    squeeze = lambda c: F.trim(F.regexp_replace(c, " +", " "))
    return F.coalesce(text != clean, F.lit(False)) & (squeeze(text) != squeeze(clean))


def canonical_fields(df: DataFrame, table_name: str, key: str, fields: list[str], words: DataFrame | None = None, max_cost: int = 1, most: int = MAX_WORDS) -> DataFrame:
    """(table_name, row_id, field_name, original, canonical) of every text that changes; ``words`` is a ``vocabulary``."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("original")) for f in fields]))
    flat = df.select(F.col(key).alias("row_id"), each.alias("x")).select("row_id", "x.*").where(~F.col("original").rlike(r"^[\x00-\x7f]*$"))
    out = flat.withColumn("canonical", F.col("original"))
    held: list[str] = []
    for part in parts_of(words, most) if words is not None else []:
        if held:
            out = materialize(out.withColumn("canonical", _applied(F.col("canonical"), held, False, max_cost)))
        held = part
    out = out.withColumn("canonical", _applied(F.col("canonical"), held, True, max_cost))
    return out.where(changed(F.col("original"), F.col("canonical"))).select(F.lit(table_name).alias("table_name"), "row_id", "field_name", "original", "canonical")
