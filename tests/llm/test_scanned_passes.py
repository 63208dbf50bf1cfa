"""The passes over whole texts, by themselves: what they find, and how often they look at a line."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from medloom.llm import scanned as S

SPACES = [" ", "  ", "\t", "\r", "\x0b", "\x1f", "\x85", "\xa0", " ", " ", "\n", "\n", "\r\n"]


class Docs:
    """Stands for a frame of (doc, text); keeps what it is told to run."""

    def __init__(self, texts):
        self.batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc", "text"])

    def select(self, *_):
        return self

    def mapInArrow(self, run, schema):
        return [r for b in run(iter([self.batch])) for r in zip(*(c.to_pylist() for c in b.columns))]


class Asked(set):
    """A filter of plain keys."""

    def __contains__(self, key):
        return super().__contains__(int(key))

    def passed(self, keys):
        return np.array([k in self for k in keys], dtype=bool)


def odd_texts():
    pick = random.Random(5)
    parts = [*SPACES, "word", "Word,", "(x)", "a-", "12", "1", "", "q" + S.NOT_SIGN, "w" + S.SHY, "Σ", "rn", "-", "é‐", "--- Page 2 ---"]
    return ["", " ", "\n", "a-\n", "12  Head\nbroken-\n \x1fword"] + ["".join(pick.choice(parts) for _ in range(pick.randint(0, 60))) for _ in range(400)]


def split(text):
    """Words of a text; a broken one is none."""
    out, lines = [], text.split("\n")
    glue = ""
    for k, line in enumerate(lines):
        words = line.split()
        if glue and words:
            words[0] = glue + words[0]
            glue = ""
        if words and k + 1 < len(lines) and line.rstrip(" \t\r")[-1:] in tuple(S.SIGNS):
            glue = words.pop()[:-1] + "\x01"
        out += words
    return out + [glue] * bool(glue)


def check_passes(texts):
    every = [split(t) for t in texts]
    words = Counter(w for t in every for w in t if "\x01" not in w)
    wanted = S._plain_keys(b"word")[0]
    wanted = wanted - (1 << 64) if wanted >= 1 << 63 else wanted
    got = Counter()
    for w, line, n in S.counts(Docs(texts), Asked({wanted})):
        got[w if line is None else line] += n
    lines = sum(S._plain(x).strip(S._EDGE_BYTES) == b"word" for t in texts for x in t.split("\n"))
    assert lines and got.pop(wanted) == lines and got == words

    near = Counter((S._form(a), S._form(b)) for t in every for a, b in zip(t, t[1:]))
    near = {k: n for k, n in near.items() if k[1] == "word" or k == ("x", "12")}
    got = Counter()
    for a, b, n in S.neighbours(Docs(texts), Asked({S._crc("x", "12")}), Asked({S._crc("word")})):
        got[a, b] += n
    assert near and got == near

    seen = []
    for doc, t in enumerate(texts):
        for no, line in enumerate(t.split("\n"), 1):
            ws = line.split()
            seen += [(doc, no, w, k == 0, k == len(ws) - 1) for k, w in enumerate(ws) if w in ("word", "a-")]
    assert seen and sorted(S.seen_tokens(Docs(texts), Asked({S._crc("word"), S._crc("a-")}))) == sorted(seen)


def test_passes_part_words_and_lines_as_strings_do(monkeypatch):
    check_passes(odd_texts())
    # a batch in parts, each of few bytes
    whole = sorted(map(str, S.edges(Docs(odd_texts()), 3)))
    monkeypatch.setattr(S, "PART_BYTES", 100)
    check_passes(odd_texts())
    assert sorted(map(str, S.edges(Docs(odd_texts()), 3))) == whole


def test_passes_without_texts():
    none = Docs([])
    assert S.edges(none, 3) == S.counts(none, Asked()) == S.neighbours(none, Asked(), Asked()) == S.seen_tokens(none, Asked()) == []


def test_lines_that_come_again_are_looked_at_once(monkeypatch):
    # every line of every text was, which took most of the pass
    texts = [f"--- Page 1 ---\n\nHead of part {i}\nthe same words here\nand week {i}\n" for i in range(50)]
    calls, keys = [], S._plain_keys
    monkeypatch.setattr(S, "_plain_keys", lambda line: calls.append(line) or keys(line))
    S.counts(Docs(texts), Asked())
    assert b"the same words here" in calls and len(calls) == len(set(calls))
    calls.clear()
    S.edges(Docs(texts), 3)
    assert calls.count(b"the same words here") == 1
