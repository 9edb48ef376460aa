"""Personal data: patterns against Python's regex, terms against plain counts."""
import hashlib
import math
import random
import re
from collections import defaultdict

from veilset.llm import pii

from .helpers import MESSY, SF2, empty, messy, read

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c)
               for i, c in enumerate(reversed(d))) % 10 == 0


def ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": all(int(x) <= 255 for x in m.split(".")) if kind == "ip" else 0,
            "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]


def base(text):
    return [(k, m.start(), m.end(), m.group()) for k, r in KINDS.items()
            for m in re.finditer(r, text or "") if ok(k, m.group())]


def digest(found):
    return ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in found)


def entity(k, v):
    return (k, v.lower() if k == "email" else v if k == "ip" else re.sub("[^0-9]", "", v))


SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def near(text, found, p):
    """(entity, context, term, start, end) beside each base span."""
    for k, a, b, v in found:
        same = [m.span() for m in re.finditer(KINDS[k], text) if k != "card" or
                len(re.sub("[^0-9]", "", m.group())) >= 16]
        at = same.index((a, b))
        left0 = same[at - 1][1] if at else 0
        right1 = same[at + 1][0] if at + 1 < len(same) else len(text)
        l0, r1 = max(left0, a - p.context_chars), min(right1, b + p.context_chars)
        before, after = text[l0:a], text[b:r1]
        left = [(l0 + m.start(), m.group()) for m in WORD.finditer(before)]
        right = [(b + m.start(), m.group()) for m in WORD.finditer(after)]
        if len(before) >= p.context_chars:
            left = left[1:]
        if before and before[-1] not in SPACE:
            left = left[:-1]
        if after and after[0] not in SPACE:
            right = right[1:]
        if len(after) >= p.context_chars:
            right = right[:-1]
        n = p.context_words
        for s, w in left[-n:] + right[:n]:
            m = re.fullmatch(r"(?:[\W\d_]*)([^\W\d_]{3,})(?:[\W\d_]*)", w)
            if m and not re.search("[@0-9]", w):
                yield entity(k, v), (before, after), m.group(1).lower(), s + m.start(1), s + m.end(1)


def terms(docs, p):
    texts = {t or "" for _, t in docs}
    n_e, n_te, n_t = defaultdict(set), defaultdict(lambda: (set(), set())), defaultdict(int)
    for t in texts:
        found = base(t)
        for k, _, _, v in found:
            n_e[entity(k, v)].add(t)
        for e, ctx, w, *_ in near(t, found, p):
            n_te[e, w][0].add(ctx)
            n_te[e, w][1].add(t)
        for w in {x.lower() for x in re.findall(r"[^\W\d_]+", t)}:
            n_t[w] += 1
    told = {}
    for (e, w), seen in n_te.items():
        n = min(map(len, seen))
        if n >= p.min_contexts:
            known = math.log2(len(texts) / len(n_e[e]))
            both = min(n, n_t[w], len(n_e[e]))
            if known > 0:
                told[e, w] = math.log2(len(texts) * both / (n_t[w] * len(n_e[e]))) / known
    return {k: v for k, v in told.items() if v >= p.generalise_at}


def expected(docs, p=pii.Params()):
    told = terms(docs, p)
    out = []
    for d, t in docs:
        found = base(t)
        extra = sorted({("term", a, b) for e, _, w, a, b in near(t or "", found, p)
                        if (e, w) in told})
        n = [sum(k == f[0] for f in found) for k in KINDS]
        out.append((d, *n, hashlib.sha256(digest(found).encode()).hexdigest(),
                    digest([*found, *extra]), len(extra)))
    return sorted(out, key=repr)


def check(df, docs, p=pii.Params()):
    assert sorted(map(tuple, pii.find(df, p).collect()), key=repr) == expected(docs, p)


def test_whole_table(spark):
    check(spark.read.parquet(f"{SF2}/documents.parquet"),
          [(d["doc_id"], d["text"]) for d in read(SF2, "documents")])


def test_messy_rows(spark):
    check(messy(spark), [(m[0], m[1]) for m in MESSY])


def test_empty_table(spark):
    assert pii.find(empty(spark)).collect() == []
    assert pii.sanitise(empty(spark)).columns == empty(spark).columns


def noise(n, seed):
    """Random strings over the patterns' own characters."""
    rnd = random.Random(seed)
    parts = ["1", "23", "255", "256", ".", ".", "-", " ", " ", "@", "a", "B.", "_", "+", "+1 ",
             "(", ")", "4111 1111 1111 1111", "5500-0000-0000-0004", "10.0.0.1", "x@y.zz", ",",
             "é", "😀", "\n", "0" * 17, "+49 30 1234567"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(60))) for _ in range(n)]


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def test_patterns_on_noise(spark):
    docs = list(enumerate(noise(1500, 4)))
    check(frame(spark, docs), docs)


def story(n=40):
    """A person whose mail address always comes with a rare name and place."""
    rnd = random.Random(8)
    common = ["with", "from", "under", "river", "table", "green", "house", "window", "letter"]
    say = lambda k: " ".join(rnd.choice(common) for _ in range(k))
    docs = [(i, f"{say(12)} Quillfeather, of {say(2)} writes from zed.q@mail.example as "
                f"baker {say(9)} or calls +1 (555) 010-20{i:02d} {say(3)}") for i in range(6)]
    docs += [(100 + i, f"{say(30)} baker {say(5)} u{i}@mail.example {say(6)}") for i in range(n)]
    return docs


def test_terms_that_tell_the_entity(spark):
    docs = story()
    want = expected(docs)
    assert any("term:" in r[-2] for r in want)
    check(frame(spark, docs), docs)
    got = {r["doc_id"]: r["text"] for r in pii.sanitise(frame(spark, docs)).collect()}
    for d, t in docs[:6]:
        assert "zed.q@mail.example" in t and "Quillfeather" in t
        assert "zed.q" not in got[d] and "Quillfeather" not in got[d]
        assert "[EMAIL]" in got[d] and "[PHONE]" in got[d] and "baker" in got[d]


def test_sanitise_masks_every_span_and_nothing_else(spark):
    docs = list(enumerate(noise(800, 9)))
    got = {r["doc_id"]: r["text"] for r in pii.sanitise(frame(spark, docs)).collect()}
    marks = re.escape("[EMAIL]") + "|" + "|".join(map(re.escape, ("[IP]", "[CARD]", "[PHONE]")))
    for d, t in docs:
        hidden = [False] * len(t)
        for _, a, b, _ in base(t):
            hidden[a:b] = [True] * (b - a)
        assert re.sub(marks, "", got[d]) == "".join(
            c for c, h in zip(t, hidden, strict=True) if not h)


def test_sanitise_keeps_columns_and_rows(spark):
    docs = messy(spark)
    out = pii.sanitise(docs)
    assert out.columns == docs.columns and out.count() == len(MESSY)
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    assert text[2] is None and text[3] == "" and text[7] == MESSY[9][1]
    assert text[8] == "[CARD] and 10.0.0.256 and [IP] [EMAIL][EMAIL]"


def test_no_python_in_the_plan(spark):
    plan = pii.find(messy(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_terms_go_wherever_they_stand_with_their_entity(spark):
    """Far from the address, and a second time in the text; not in other texts."""
    rnd = random.Random(5)
    say = lambda k: " ".join(rnd.choice(["river", "table", "green", "house"])
                             for _ in range(k))
    docs = [(i, f"Far: Quillfeather! {say(30)} far@mail.example {say(30)} (Wimblestone), "
                f"quillfeather's {say(3)}") for i in range(6)]
    docs += [(100 + i, f"{say(30)} u{i}@mail.example {say(6)}") for i in range(60)]
    got = {r["doc_id"]: r["text"] for r in pii.sanitise(frame(spark, docs)).collect()}
    for d, t in docs[:6]:
        assert not re.search("quillfeather|wimblestone|far@", got[d], re.I)
        assert "river" in got[d] or "river" not in t
    assert all(got[d] == re.sub(r"u\d+@mail.example", "[EMAIL]", t) for d, t in docs[6:])
