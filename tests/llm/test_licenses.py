"""License matches: repeated notices, alignment against a plain one, long texts, ties."""

import random

import numpy as np
import pytest

from linefold.llm import license_scan as L

INDEX = L.Index(L.TEMPLATES)
MIT = "Released under the MIT License."


def spans(text):
    return [(m["license"], text[m["start"] : m["end"]]) for m in L.find(INDEX, [text])[0]]


def test_every_place_of_a_repeated_notice():
    want = ("MIT", MIT[:-1])
    assert spans(f"{MIT} {MIT}") == [want] * 2
    assert spans(" and then comes ".join([MIT] * 500)) == [want] * 500
    assert spans(MIT * 7) == [want] * 7
    gpl = "This work is licensed under the GNU General Public License, version 3"
    edited = f"{gpl}. {gpl.replace('licensed', 'now licensed')}. {gpl.replace('work is ', '')}. {gpl}"
    assert [s for _, s in spans(edited)] == [gpl, gpl.replace("licensed", "now licensed"), gpl.replace("work is ", ""), gpl]


def test_full_texts_and_long_documents():
    names = ["MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause"]
    full = {n: max((t for k, t in L.TEMPLATES if k == n), key=len) for n in names}
    text = "word " * 50_000 + " end. ".join(full.values()) + " word" * 50_000
    assert [m["license"] for m in L.find(INDEX, [text])[0]] == names
    grant = full["MIT"].split("The above")[0]
    assert [(m["license"], m["coverage"]) for m in L.find(INDEX, [f"so {grant} and so on"])[0]] == [("MIT", 1.0)]
    assert L.find(INDEX, ["", "two words", "x" * 300_000]) == [[], [], []]


def test_ties_go_to_the_first_template_name():
    index = L.Index([("B", "alpha beta gamma delta epsilon"), ("A", "alpha beta gamma delta epsilon")])
    assert [m["license"] for m in L.find(index, ["so alpha beta gamma delta epsilon it is"])[0]] == ["A"]


def plain(template, words):
    """(score, matched) of the best alignment of the whole template anywhere in the words, all cells."""
    prev = [(0, 0)] * (len(words) + 1)
    for t in template:
        row = [(prev[0][0] - 1, prev[0][1])]
        for j, w in enumerate(words, 1):
            s, m = prev[j - 1]
            diag = (s + 1, m + 1) if t == w else (s - 1, m)
            row.append(max(diag, (prev[j][0] - 1, prev[j][1]), (row[-1][0] - 1, row[-1][1])))
        prev = row
    return max(prev)


def test_alignment_against_a_plain_one():
    rnd = random.Random(3)
    for _ in range(150):
        n = rnd.randrange(3, 12)
        template = [rnd.randrange(1, 5) for _ in range(n)]
        band = n + 6
        window = np.zeros((1, n + 2 * band), np.int64)  # filled where no path leaves the band
        window[0, n : 2 * band] = [rnd.randrange(0, 6) for _ in range(2 * band - n)]
        m, a, b = L.align(np.array(template), window)
        score, matched = plain(template, window[0].tolist())
        assert m[0] == matched and (not m[0] or (0 <= a[0] < b[0] <= window.shape[1] and window[0][a[0]] in template and window[0][b[0] - 1] in template))


def test_candidates_are_found_by_brute_force_too():
    """Every notice whose words all occur in a row has a match that covers it."""
    rnd = random.Random(5)
    filler = "the of license version work under terms any copy word".split()
    for _ in range(60):
        picks = [rnd.choice(L.TEMPLATES) for _ in range(3)]
        text = ". ".join(" ".join(rnd.choice(filler) for _ in range(rnd.randrange(8))) + " " + t for _, t in picks)
        found = spans(text)
        assert len(found) >= 3
        for _, t in picks:
            words = L._words(t)
            assert any(" ".join(words[:3]) in " ".join(L._words(s)) or L._words(s) == words for _, s in found)


def edited(words, changed, rnd):
    """``changed`` words replaced, or, as far as the band reaches, left out."""
    out = list(words)
    for k, p in enumerate(rnd.sample(range(len(words)), changed)):
        out[p] = rnd.choice(["", f"other{rnd.randrange(50)}"]) if k < L.BAND else f"other{rnd.randrange(50)}"
    return " ".join(w for w in out if w)


def test_edited_notices_are_found():
    """As many words changed as the coverage allows: every template is found wherever it covers enough, short ones too."""
    rnd = random.Random(9)
    for k, (name, text) in enumerate(L.TEMPLATES):
        words = L._words(text)
        most = len(words) - -(-8 * len(words) // 10)
        assert most == 0 or L.unbroken(len(words)) >= 2
        found = 0
        for _ in range(60):
            body = f"some words before {edited(words, rnd.randrange(1, most + 1), rnd)} and after it"
            found += any(m["license"] == name or m["matched"] >= 0.8 * len(words) for m in L.find(INDEX, [body])[0])
        assert found >= 0.9 * 60, (name, k, found)


def test_a_run_is_certain():
    """However the allowed number of words is struck out, a run of the promised length is left."""
    from itertools import combinations

    for n in range(1, 16):
        gone = n - -(-8 * n // 10)
        least = min(max(map(len, "".join("x" if p in out else "." for p in range(n)).split("x"))) for out in map(set, combinations(range(n), gone)))
        assert least >= L.unbroken(n)


def test_long_templates():
    words = [f"w{i % 7000}" for i in range(20_000)]
    index = L.Index([("long", " ".join(words))])
    found = L.find(index, ["before " + " ".join(words) + " after"])[0]
    assert [(m["license"], m["coverage"]) for m in found] == [("long", 1.0)]
    with pytest.raises(ValueError):
        L.Index([("too long", "w " * (L.MOST_WORDS + 1))])
