import re
from collections import Counter

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from driftloom.llm.quality import base_counts
from driftloom.llm.words import sliced, windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.none() | st.text(st.sampled_from("ab \n\t\r#é😀 "), max_size=60), min_size=1, max_size=6)


def plain(text):
    """The base counts, straight from their definition."""
    words = WORD.findall(text)
    spans = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = set()
    for i in range(len(words) - 4):
        if spans[tuple(words[i : i + 5])] > 1:
            hit |= set(range(i, i + 5))
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(hit)]


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_base_counts_and_words(texts):
    got, words = [], []
    for _, part in sliced(pa.array(texts, pa.string())):
        counts = base_counts(part)
        got += [list(map(int, r)) for r in zip(*counts.values())]
        hashes = part.word_hashes()
        words += [hashes[part.words[i] : part.words[i + 1]].tolist() for i in range(len(part))]
    assert got == [plain(t or "") for t in texts]
    names: dict = {}
    for t, hashes in zip(texts, words):
        for w, h in zip(WORD.findall(t or ""), hashes, strict=True):
            assert names.setdefault(w, h) == h  # equal words, equal hashes
    assert len(set(names.values())) == len(names)


def test_slices_of_an_offset_array():
    column = pa.array(["x", "a b", None, "c\nd e"]).slice(1)
    parts = [p for _, p in sliced(column)]
    assert sum(len(p) for p in parts) == 3
    assert [int(n) for p in parts for n in base_counts(p)["n_words"]] == [2, 0, 3]


def test_windows_tell_order():
    import numpy as np

    h = np.array([1, 2, 3, 2, 1], np.uint64)
    assert len(set(windows(h, 2).tolist())) == 4
    assert len(windows(h, 6)) == 0
