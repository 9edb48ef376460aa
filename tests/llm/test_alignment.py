"""Token alignment against whole texts through both libraries, in plain Python."""
import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer, decoders

from veilset.llm import alignment

from .helpers import MESSY, SF1, empty, messy, read, rows

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    """Each text as a whole; ends from decoded bytes alone."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        level = decoders.ByteLevel().decode
        # a token alone may be part of a character: its bytes by the alphabet
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        self.value = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        assert level([chr(256 + i) for i in range(33)]) == bytes(rest[:33]).decode()

    def tokens(self, text):
        if not text:
            return [], []
        want = (" " + text).encode()
        a = [(i, bytes(self.value[c] for c in self.a.id_to_token(i)))
             for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
              else self.b.id_to_piece(i).replace("▁", " ").encode())
             for i in self.b.encode(text)]
        if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            return [], []
        return a, b

    def groups(self, text):
        a, b = self.tokens(text)
        out, i, j = [], 0, 0
        while i < len(a):
            left, right = [a[i]], [b[j]]
            i, j = i + 1, j + 1
            while (x := sum(len(t) for _, t in left)) != (y := sum(len(t) for _, t in right)):
                if x < y:
                    left.append(a[i])
                    i += 1
                else:
                    right.append(b[j])
                    j += 1
            out.append(([k for k, _ in left], [k for k, _ in right]))
        return len(a), len(b), out


def expected(docs):
    plain = Plain()
    every = [(d, *plain.groups(t)) for d, t in docs]
    count = Counter((g[1][-1], g[0][-1]) for *_, groups in every for g in groups)
    highest: dict = {}
    for (b, _), n in count.items():
        highest[b] = max(n, highest.get(b, 0))
    out = []
    for doc_id, n_a, n_b, groups in every:
        links = [(g[1][-1], g[0][-1]) for g in groups]
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((doc_id, n_a, n_b, len(groups), len(links),
                    sum(count[k] == highest[k[0]] for k in links), sum(count[k] for k in links),
                    hashlib.sha256(shown.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


ODD = ["a  b", "a   ", " a", "   ", " ", "a\n b", "a \n b", "a\n \n b", "a\n  b", "a \t b  \n", "\n",
       "x▁y z", "▁", "a\x1cb \x1c c", "\x00 \x00", "<s> </s> <|endoftext|> <0x41>",
       "   a 　 b", "it's we'll 'twas ' s", "\U0001f9ff\U0001f600 \U00012345 ሴ",
       "日本語 日 本", "é ̈ x", "a\r\n b\r\n  c();\r\n", "12 345 6789", "ﬁ ﬀ",
       "def f(x):\n    return x\n\n\n        y\n", "a" * 400 + " " * 300 + "b" * 99]


def test_messy_rows_equal_whole_texts(spark):
    given = MESSY + [(200 + i, t, None, None) for i, t in enumerate(ODD)]
    got = rows(alignment.align(messy(spark, given), A, B))
    assert got == expected([(i, t) for i, t, *_ in given])
    assert rows(alignment.align(empty(spark), A, B)) == []


@pytest.mark.parametrize("chars", [2_000, 16_000_000])
def test_whole_table(spark, chars):
    docs = spark.read.parquet(f"{SF1}/documents.parquet").repartition(3)
    got = rows(alignment.align(docs, A, B, alignment.Params(batch_chars=chars, remembered=500)))
    assert got == expected([(r["doc_id"], r["text"]) for r in read(SF1, "documents")])


def test_random_texts_and_stretches(monkeypatch):
    monkeypatch.setattr(alignment, "_STRETCH", 40)
    monkeypatch.setattr(alignment, "_LEARN", 60)
    random.seed(11)
    aligner, plain = alignment.Aligner(A, B, alignment.Params()), Plain()
    alphabet = [" ", " ", "  ", "\n", "\t", "\r\n", " ", "\x1c", " ", "​", "a", "the",
                "Zürich", "日", "\U0001f9ff", "ሴ", ".", "'s", "12", "́", "(", "});", "_"]
    for _ in range(3000):
        text = "".join(random.choices(alphabet, k=random.randrange(1, 60)))
        n_a, n_b, groups = plain.groups(text)
        parts = aligner.of_long(text)
        if len(text) < 39:                       # a single stretch
            one, = parts
            other, = aligner.of([text])[0]
            assert (one[0], one[1].tolist(), one[2]) == (other[0], other[1].tolist(), other[2])
        shown = "".join(p[0] for p in parts)
        assert shown == "".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) + ";"
                                for a, b in groups), ascii(text)
        assert sum(p[2] for p in parts) == n_a | n_b << 32


def test_spans_place_what_decoded_bytes_refine():
    aligner = alignment.Aligner(A, B, alignment.Params())
    text = " \U0001f9ff日é"
    for ids, ends in (aligner._a_ends(text, text.encode()), aligner._b_ends(text, text.encode())):
        assert ends[-1] == len(text.encode()) and (ends[1:] > ends[:-1]).all()
