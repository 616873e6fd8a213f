import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from compare import connect, differences
from sluicebox.llm import fm_index, spelling
from sluicebox.llm.spelling import spelling_forms

COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute_force(docs):
    counted = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counted[run] += 1
    words = {word: n for word, n in counted.items() if len(word) >= 7 and n >= 2}
    near = {a: [b for b in words if one_apart(a, b)] for a in words}
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= 10 * words[word]:
            forms[word] = best
    found = []
    for word, n in words.items():
        root = word
        while root in forms:
            root = forms[root]
        found.append((word, n, len(near[word]), forms.get(word), words.get(forms.get(word)), root))
    return sorted(found, key=str)


def forms_of(spark, docs):
    df = spark.createDataFrame([(*row, 1, "y") for row in docs], "doc_id long, text string, n long, word string")
    return sorted((tuple(row) for row in spelling_forms(df).select(COLUMNS).collect()), key=str)


def test_equals_sql(spark):
    assert differences(spark, connect("/root/testdata/sf0.01"), "/root/testdata/sf0.01", "op11_fm_index_spelling") == []


def test_index_finds_every_word_one_error_away():
    draw = random.Random(5)
    words = sorted({"".join(draw.choice("abé") for _ in range(draw.randint(7, 9))) for _ in range(300)})
    index = fm_index.BidirectionalIndex(words)
    for length in (7, 8, 9):
        queries = [word for word in words if len(word) == length] + ["ÿ" * length]
        letters = np.stack([fm_index.numbers(word) for word in queries])
        found = set()
        for side in (fm_index.LEFT, fm_index.RIGHT):
            rows, numbers = index.near(letters, length // 2, side)
            found |= {(queries[row], words[number]) for row, number in zip(rows, numbers, strict=True)} - {(w, w) for w in words}
        assert found == {(a, b) for a in queries for b in words if one_apart(a, b)}


@pytest.mark.parametrize("group_words", [3, 4_000])
def test_equals_brute_force(spark, group_words, monkeypatch):
    """Words with many others near, in groups cut into several indexes and not; upper case, NULLs, repeated rows."""
    monkeypatch.setattr(spelling, "GROUP_WORDS", group_words)
    monkeypatch.setattr(spelling, "CHARS", 100)
    draw = random.Random(3)
    base = ["abcabca", "bcabcabc", "Écoleécole", "nationnation", "aaaaaaaa", "ÿÀabcdefg"]
    docs = []
    for doc in range(60):
        words = []
        for _ in range(60):
            word = draw.choice(base + base[:1] * 6)
            if draw.random() < 0.3:
                at = draw.randrange(len(word))
                word = word[:at] + draw.choice(["", "a", "é", "Bc"]) + word[at + draw.randint(0, 1) :]
            words.append(word.upper() if draw.random() < 0.1 else word)
        docs.append((doc if doc else None, draw.choice([" ", "-", "\n1"]).join(words)))
    docs += [(70, None), (71, ""), (72, "short words"), *docs[:3]]
    docs += [(80, "qwertyu " * 3 + "qwertyui " * 40 + "qwertyuio " * 500)]
    expected = brute_force(docs)
    assert forms_of(spark, docs) == expected
    assert sum(row[3] is not None for row in expected) > 20 and any(row[3] != row[5] and row[3] for row in expected)


def test_edges(spark, monkeypatch):
    assert forms_of(spark, []) == [] and forms_of(spark, [(1, None), (2, "a b")]) == []
    long = "ab" * 300_000
    docs = [(i, f"{long} {long}x x{long} {long[:400]}y{long[401:]}") for i in (1, 1)]
    found = {row[0]: row for row in forms_of(spark, docs)}
    assert all(row[1] == 2 for row in found.values()) and sorted(row[2] for row in found.values()) == sorted(
        sum(one_apart(a, b) for b in found) for a in found
    )
    # Words on either side of the length from which no index is used.
    monkeypatch.setattr(spelling, "LONG", 10)
    draw = random.Random(1)
    docs = [(1, " ".join("".join(draw.choice("ab") for _ in range(draw.randint(8, 12))) for _ in range(600)))] * 2
    assert forms_of(spark, docs) == brute_force(docs)
