import random

from data import docs

from profila.llm import licenses as L


def plain_increasing(p):
    best = [[]]
    for x in p:
        best += [b + [x] for b in best if not b or b[-1] < x]
    return max(map(len, best))


def plain_align(text, template):
    """Patience alignment by its definition, recursively."""
    if not text or not template:
        return 0
    if text[0] == template[0]:
        return 1 + plain_align(text[1:], template[1:])
    if text[-1] == template[-1]:
        return 1 + plain_align(text[:-1], template[:-1])
    anchors = [(i, template.index(w)) for i, w in enumerate(text) if text.count(w) == 1 and template.count(w) == 1]
    if not anchors:
        return 0
    keep = [anchors[k] for k in L.increasing([j for _, j in anchors])]
    assert len(keep) == plain_increasing([j for _, j in anchors])
    edges, total = [(-1, -1), *keep, (len(text), len(template))], len(keep)
    for (i, j), (k, m) in zip(edges, edges[1:]):
        total += plain_align(text[i + 1:k], template[j + 1:m])
    return total


def test_alignment_against_definition():
    rng = random.Random(4)
    for _ in range(300):
        template = [f"t{rng.randrange(9)}" for _ in range(rng.randrange(1, 12))]
        text = [w for w in template if rng.random() < 0.8] + [f"t{rng.randrange(12)}" for _ in range(3)]
        if rng.random() < 0.3:
            rng.shuffle(text)
        pairs = L.align(text, template)
        assert all(text[i] == template[j] for i, j in pairs)
        assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))
        assert len(pairs) == plain_align(text, template)


def test_finds_each_notice(spark):
    rng, rows, want = random.Random(5), [], {}
    names = sorted(L.TEMPLATES)
    for i in range(len(names) + 20):
        name, filler = names[i % len(names)], [f"f{rng.randrange(99)}" for _ in range(rng.randrange(400))]
        at = rng.randrange(len(filler) + 1)
        rows.append((i, " ".join(filler[:at]) + "\n" + L.TEMPLATES[name].upper() + ".\n" + " ".join(filler[at:]), "s"))
        want[i] = name
    got = L.scan(docs(spark, rows)).collect()
    assert {r.doc_id: r.license for r in got} == want and len(got) == len(rows)
    texts = {i: t for i, t, _ in rows}
    assert all(r.coverage == 1 and L.words_of(texts[r.doc_id][r.start:r.end]) == L.words_of(L.TEMPLATES[r.license]) for r in got)


def test_edits_repeats_and_near_misses():
    scan = lambda t: [(x["license"], round(x["coverage"], 2)) for x in L.Scanner(L.TEMPLATES).scan([t])[0]]
    assert scan("Released under the MIT License. Released under the MIT License. " * 3) == [("MIT", 1.0)] * 6
    assert scan("This work is licensed under the old GNU General Public License, vers 3") == [("GPL-3.0", 0.92)]
    assert scan("Released under the ABC License") == [] and scan("rights all reserved") == []
    assert scan(None) == [] and scan("") == [] and scan("the " * 100_000) == []


def test_nulls_and_empty_tables(spark):
    df = docs(spark, [(None, "All rights reserved.", None), (1, None, "a"), (2, "", "a"), (3, "all RIGHTS reserved", "a"), (3, "all RIGHTS reserved", "a")])
    assert sorted([(r.doc_id, r.license) for r in L.scan(df).collect()], key=str) == [(3, "Proprietary")] * 2 + [(None, "Proprietary")]
    assert L.scan(docs(spark, [])).count() == 0 and L.scan(df, {"none": "", "other": "..."}).count() == 0


def found(text):
    return [x["license"] for x in L.Scanner(L.TEMPLATES).scan([text])[0]]


def test_variants_are_told_apart():
    for code, name in (("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY", "Attribution")):
        assert found(f"This work is licensed under a Creative Commons {name} 4.0 International License.") == [f"CC-{code}-4.0"]
    assert found("Licensed under CC BY-NC-SA 4.0") == ["CC-BY-NC-SA-4.0 line"]
    assert found("licensed under the MIT License") == ["MIT licensed"] and found("SPDX-License-Identifier: MPL-2.0") == ["MPL-2.0 identifier"]
    texts = L.license_texts.templates()
    for name in ("GPL-2.0-or-later notice", "GPL-3.0-or-later notice", "LGPL-2.1-or-later notice", "AGPL-3.0-or-later notice",
                 "MIT text", "BSD-2-Clause text", "BSD-3-Clause text", "ISC text", "0BSD text", "Unlicense text", "Apache-2.0 full notice"):
        words = texts[name].split()
        words[len(words) // 2] = "changed"  # a whole text with an edit stays the whole text
        assert found("Copyright (c) 2020 A. Nother. " + " ".join(words) + " more") == [name]


def test_filter_by_different_words_loses_nothing():
    rng, scanner = random.Random(11), L.Scanner({f"t{k}": " ".join(f"w{(k * 7 + j * j) % 23}" for j in range(12)) for k in range(20)})
    for _ in range(60):
        name, words = rng.choice(scanner.templates)
        text = [f"x{rng.randrange(9)}" for _ in range(9)] + [w for w in words if rng.random() < 0.95] + [f"w{rng.randrange(23)}" for _ in range(9)]
        ids = L.np.array([scanner.number.get(w, 0) for w in text])
        known, least = L.np.flatnonzero(ids), scanner.least
        got = scanner.finds(text, ids, known)
        scanner.least = least * 0
        assert scanner.finds(text, ids, known) == got
        scanner.least = least
