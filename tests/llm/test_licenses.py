from __future__ import annotations

import random

import numpy as np

from lapseflow.llm import licenses as d

SCANNER = d.Scanner(d.TEMPLATES)


def names(text):
    return [(n.license, n.exact) for n in SCANNER.scan(text)]


def test_each_template_is_found_exactly(prose):
    for name, text in d.TEMPLATES.items():
        assert names(f"{prose(1, 40)}\n{text}\n{prose(2, 40)}") == [(name, True)], name
        assert names(text.upper()) == [(name, True)], name


def test_changed_words_are_told():
    text = d.TEMPLATES["GPL-header"].replace("any later version", "any newer version").replace("free software", "free test software")
    (notice,) = SCANNER.scan(text)
    assert notice.license == "GPL-header" and not notice.exact
    assert notice.missing == ["later"] and notice.added == ["test", "newer"]


def test_best_of_alike_templates():
    assert names("This work is licensed under the GNU General Public License, version 2.") == [("GPL-2.0", True)]
    assert names("Licensed under CC BY-SA 4.0.") == [("CC-BY-SA-4.0", True)]


def test_places_and_neighbouring_notices(prose):
    text = f"É {prose(1, 9)}\nReleased under the MIT License.\nLicensed under CC BY 4.0.\n\n{prose(3, 9)} permission software"
    found = SCANNER.scan(text)
    assert [text[n.start : n.end] for n in found] == ["Released under the MIT License.", "Licensed under CC BY 4.0."]


def test_wrapped_notice_is_one_block():
    words = d.TEMPLATES["MIT-text"].split()
    text = "\n".join(" ".join(words[i : i + 12]) for i in range(0, len(words), 12))
    assert names("Intro.\n\n" + text)[0] == ("MIT-text", True)


def test_plain_prose_has_none(prose):
    assert names(prose(5, 3000)) == []
    assert names("The software is distributed to every person in the notice; conditions apply to all.") == []
    assert names("A license to kill, the permission of the public.") == []


def test_notice_within_a_line(prose):
    mit, one = d.TEMPLATES["MIT"], "Six words stand before this notice."
    for text in (f"{prose(1, 30)}. {mit} {prose(2, 400)}", f"{one} {mit}", f"{mit} {one} {prose(3, 40)}"):
        (notice,) = SCANNER.scan(text)
        assert (notice.license, notice.exact, text[notice.start : notice.end]) == ("MIT", True, mit)


def _wrapped(name, width):
    words = d.TEMPLATES[name].split()
    return "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))


def test_whole_texts_and_neighbours(prose):
    for name in d.TEMPLATES:
        for width in (7, 12):
            assert names(f"Copyright (c) 2020 Somebody\n\n{_wrapped(name, width)}") == [(name, True)], name
    for gap in ("\n", "\n\n", " "):
        for first, second in (("MIT-text", "ISC"), ("MIT-whole", "BSD-3-Clause-whole"), ("GPL-2.0", "GPL-3.0"), ("MIT", "MIT")):
            assert names(_wrapped(first, 12) + gap + _wrapped(second, 12)) == [(first, True), (second, True)], (first, second, gap)
    # A disclaimer of other words leaves the grant, which is a notice of its own.
    assert names(_wrapped("MIT-text", 9) + "\n" + prose(4, 200)) == [("MIT-text", True)]


def test_overlapping_rest_is_looked_at_again():
    # The second notice lacks its first words, which the first one holds.
    text = f"{d.TEMPLATES['Apache-2.0']} {d.TEMPLATES['CC-BY-4.0']} {d.TEMPLATES['Apache-2.0']}"
    assert names(text) == [("Apache-2.0", True), ("CC-BY-4.0", True), ("Apache-2.0", True)]


def _distance(want, have):
    """Words missing or added, by the longest common subsequence."""
    row = [0] * (len(have) + 1)
    for w in want:
        last, row = row, [0]
        for j, h in enumerate(have):
            row.append(last[j] + 1 if w == h else max(last[j + 1], row[j]))
    return len(want) + len(have) - 2 * row[-1]


def test_spans_against_brute_force():
    draw = random.Random(1)
    for _ in range(60):
        want, have = ([draw.randrange(5) for _ in range(draw.randrange(1, most))] for most in (7, 16))
        starts, far = d.best_spans(np.array(want), np.array(have))
        for end in range(len(have) + 1):
            said = min((_distance(want, have[a:end]), a) for a in range(end + 1))
            assert (far[end], starts[end]) == said, (want, have, end)


def test_every_template_with_enough_words_is_confirmed():
    # No template that the compression ranks low is left out: all spans of all templates, by brute force.
    draw = random.Random(2)
    vocabulary = [w for name in ("MIT", "BSD-2-Clause", "Apache-2.0", "CC-BY-4.0") for w in d._words(d.TEMPLATES[name])]
    few = d.Scanner({k: v for k, v in d.TEMPLATES.items() if len(v.split()) <= 9})
    for _ in range(60):
        have = [draw.choice(vocabulary) for _ in range(draw.randrange(25))]
        found = few.candidates(have)
        for name, want in few.words.items():
            fits = [
                (a, b)
                for b in range(len(have) + 1)
                for far, a in [min((_distance(want, have[a:b]), a) for a in range(b + 1))]
                if (len(want) + b - a - far) / 2 >= max(1, d.LEAST_SHARED * len(want))
            ]
            own = [(c.start, c.end) for c in found if c.name == name]
            assert set(own) <= set(fits)
            assert all(any(a < e and s < b for s, e in own) for a, b in fits)
        # What is left between the blocks chosen holds no further candidate.
        text = " ".join(have)
        places = [m.span() for m in d._WORD.finditer(text)]
        edges = [0, *[x for c in few.chosen(text, places) for x in (c.start, c.end)], len(have)]
        assert all(not few.candidates(have[a:b]) for a, b in zip(edges[::2], edges[1::2], strict=True))


def test_long_line_takes_linear_time():
    mit = d.TEMPLATES["MIT"] + " "
    assert names(mit * 3000) == [("MIT", True)] * 3000


def test_rows(spark, make, odd_texts):
    mit = d.TEMPLATES["MIT"]
    docs = make([*enumerate(odd_texts), (9, mit), (9, mit), (None, mit), (10, "x" * 200_000 + "\n" + mit)], clashing=True)
    got = d.license_notices(docs).collect()
    assert sorted((r["doc_id"] for r in got), key=str) == [10, 9, 9, None]
    assert {(r["license"], r["verdict"], r["notice"]) for r in got} == {("MIT", "exact", mit)}
    assert d.license_notices(make([])).count() == 0
    assert d.license_notices(docs, {}).count() == 0
