"""License scans against plain word search, alignments against a full table."""
import random
import re

from veilset.llm import licenses as L

from .helpers import MESSY, SF2, empty, messy, read


def scanner(p=L.Params(), templates=None):
    return L.Scanner(L.TEMPLATES if templates is None else templates, p)


def names(text, s=None):
    return [f[2] for f in (s or scanner()).scan(text)[1]]


def test_whole_table(spark):
    """The table's license lines are exact notices; no other text has any."""
    notice = {name: " ".join(w for w, _, _ in L.words_of(t)) for name, t in L.TEMPLATES.items()}
    got = {r["doc_id"]: r for r in
           L.scan(spark.read.parquet(f"{SF2}/documents.parquet")).collect()}
    n = 0
    for d in read(SF2, "documents"):
        words = " ".join(w for w, _, _ in L.words_of(d["text"]))
        want = sorted(k for k, t in notice.items() if re.search(rf"(?<!\S){re.escape(t)}(?!\S)",
                                                                words))
        r = got[d["doc_id"]]
        assert r["licenses"].split(",") if r["licenses"] else [] == want, d["doc_id"]
        assert ([] if not r["licenses"] else r["licenses"].split(",")) == want
        for f in r["finds"]:
            own = " ".join(w for w, _, _ in L.words_of(d["text"][f["start"]:f["end"]]))
            assert own == notice[f["license"]] and f["differences"] == 0
        n += len(want)
    assert n > 10


def prose(n, seed=1):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def test_full_texts_wrapped_changed_and_amid_prose():
    for name, text in L.TEMPLATES.items():
        words = text.split()
        wrapped = "\n".join(" ".join(words[i:i + 8]) for i in range(0, len(words), 8))
        commented = "\n".join(" * " + x.upper() for x in wrapped.split("\n"))
        assert names(wrapped) == [name], name
        assert names(f"{prose(300)}\n{commented}\n{prose(300, 2)}") == [name], name


def test_few_changed_words_are_counted_and_telling_words_decide():
    text = L.TEMPLATES["MIT-text"]
    changed = text.replace("copies of the Software, and", "copies of said Software, and").replace(
        "arising from", "coming from")
    found = scanner().scan(changed)[1]
    assert [f[2] for f in found] == ["MIT-text"] and found[0][4] >= 1
    assert names("Licensed under CC BY-NC 4.0.") == ["CC-BY-NC-4.0"]
    assert names("Licensed under CC BY-XX 4.0.") == []
    assert names("This is licensed under the GNU General Public License, version 9.") == []


def test_several_and_repeated_licenses():
    a, b = L.TEMPLATES["ISC-text"], L.TEMPLATES["Apache-2.0"]
    text = f"{b}.\n{prose(20)}\n{a}\n{prose(400)}\n\n\n\n\n\n\n{b}"
    assert names(text) == ["Apache-2.0", "ISC-text", "Apache-2.0"]


def test_long_blocks_are_scanned_whole():
    cue = "license " + prose(60, 5)
    text = "\n".join([cue] * 120 + [L.TEMPLATES["MIT-text"]] + [cue] * 120
                     + [L.TEMPLATES["GPL-3.0"]])
    assert names(text) == ["MIT-text", "GPL-3.0"]


def test_places_are_code_points():
    text = f"é😀 {prose(5)}\nÜ. Released under the MIT License."
    (a, b, name, *_), = scanner().scan(text)[1]
    assert text[a:b] == "Released under the MIT License" and name == "MIT"


def full(template, block):
    """Edit distance of the template to any stretch of the block."""
    prev = [0] * (len(block) + 1)
    for i, t in enumerate(template):
        row = [i + 1]
        for j, w in enumerate(block):
            row.append(min(prev[j] + (t != w), prev[j + 1] + 1, row[j] + 1))
        prev = row
    return min(prev)


def dist(a, b):
    prev = list(range(len(b) + 1))
    for i, t in enumerate(a):
        row = [i + 1]
        for j, w in enumerate(b):
            row.append(min(prev[j] + (t != w), prev[j + 1] + 1, row[j] + 1))
        prev = row
    return prev[-1]


def test_alignment():
    rnd = random.Random(4)
    for _ in range(300):
        t = [rnd.choice("abc") for _ in range(rnd.randrange(1, 8))]
        b = [rnd.choice("abcd") for _ in range(rnd.randrange(0, 14))]
        n, i, j = L.differences(t, b)
        assert n == full(t, b) and n == dist(t, b[i:j])


def test_messy_rows_and_empty_table(spark):
    rows = [*MESSY, (50, "Released under the MIT License.\n" * 3, None, None),
            (51, "license " * 5000, "en", "a")]
    got = sorted(L.scan(messy(spark, rows)).collect(), key=lambda r: repr(r["doc_id"]))
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["n_found"] for r in got if r["n_found"]} == {50: 3}
    assert [r["licenses"] for r in got if r["doc_id"] == 50] == ["MIT"]
    assert L.scan(empty(spark)).collect() == []


def test_own_templates(spark):
    got = L.scan(messy(spark, [(1, "use of this thing needs a license from Zork", "en", "a")]),
                 {"Zork": "needs a license from Zork"}).first()
    assert got["licenses"] == "Zork"


HEADER = ("This program is free software; you can redistribute it and/or modify it under the "
          "terms of the GNU {}General Public License as published by the Free Software "
          "Foundation; either version {} of the License, or (at your option) any later version.")


def test_telling_words_and_numbers_count_on_both_sides():
    for extra, number, want in [("", "2", ["GPL-2.0-or-later-header"]),
                                ("", "3", ["GPL-3.0-or-later-header"]), ("", "4", []),
                                ("Lesser ", "3", ["LGPL-3.0-or-later-header"]),
                                ("Lesser ", "2.1", ["LGPL-2.1-or-later-header"]),
                                ("Affero ", "3", ["AGPL-3.0-or-later-header"]),
                                ("Affero ", "2", []), ("Apache ", "3", [])]:
        assert names(HEADER.format(extra, number)) == want, (extra, number)


def test_a_rejected_place_does_not_end_the_window():
    text = HEADER.format("", "4") + " " + HEADER.format("", "3")
    assert names(text, scanner(templates={k: v for k, v in L.TEMPLATES.items() if k ==
                                          "GPL-3.0-or-later-header"})) == [
        "GPL-3.0-or-later-header"]


def test_the_license_that_holds_another_wins():
    bsd = L.TEMPLATES["BSD-3-Clause-text"]
    assert names(bsd.replace("the copyright holder nor", "Zork Inc. nor")) == ["BSD-3-Clause-text"]
    # another third clause makes no BSD-2 of it; bullets may stand for numbers
    assert names(bsd[:bsd.index("endorse")] + prose(40)) == []
    bullets = bsd.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")
    assert names(bullets) == ["BSD-3-Clause-text"]
    assert names(bullets.replace("the copyright holder nor", "Zork nor")) == ["BSD-3-Clause-text"]
    assert names(f"{prose(9)}\n{L.TEMPLATES['BSD-2-Clause-text']}\n{prose(9)}") == [
        "BSD-2-Clause-text"]
    assert names("GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n") == ["GPL-3.0-body"]


def test_size_reduction_ranks_what_wording_cannot_tell_apart(monkeypatch):
    """Two templates agree with the block in as many words and differ in one each;
    the one that differs in the shorter word saves more bytes."""
    base = ("anybody may copy this software under the following license provided that every "
            "incomprehensibilities disclaimer and all notices stay whole in each of the {} it "
            "goes to for as long as it is kept by them").split()
    block = " ".join(base).format("places")
    short = block.replace(" all notices", " two notices")
    long_ = block.replace("incomprehensibilities", "characteristically")
    two = {"A-long": long_, "B-short": short}
    s = scanner(L.Params(differing=0.1), two)
    both = {f[2]: f for t in two.items() for f in scanner(
        L.Params(differing=0.1), dict([t])).scan(block)[1]}
    assert both["A-long"][4] == both["B-short"][4] == 1
    assert names(block, s) == ["B-short"]
    monkeypatch.setattr(L.Scanner, "saved", lambda self, words, t: 10 ** 6)
    assert names(block, scanner(L.Params(differing=0.1), two)) == ["A-long"]
