"""Cross-tokenizer alignment against whole-text tokenizing and plain counting."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from txnrisk.llm.alignment import TwoTokenizers, align_documents
from txnrisk.llm.perfect_hash import PerfectHash

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    ta, tb = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    ta.encode_special_tokens = True
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}

    def groups(text):
        if not text:
            return []
        a, b = ta.encode(" " + text, add_special_tokens=False).ids, tb.encode(text)
        ab = [bytes(byte[c] for c in ta.id_to_token(i)) for i in a]
        bb = [bytes([int(tb.id_to_piece(i)[3:5], 16)]) if tb.is_byte(i)
              else tb.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(ab) != (" " + text).encode() or b"".join(bb) != (" " + text).encode():
            return []
        ea, eb = np.cumsum(list(map(len, ab))), np.cumsum(list(map(len, bb)))
        out, i, j = [], 0, 0
        for e in sorted(set(ea) & set(eb)):
            k, m = int(np.searchsorted(ea, e)) + 1, int(np.searchsorted(eb, e)) + 1
            out.append((a[i:k], b[j:m]))
            i, j = k, m
        return out

    per = [(i, groups(t)) for i, t in rows]
    links = [[(x, y) for xs, ys in g for x in xs for y in ys] for _, g in per]
    count = Counter(p for ls in links for p in set(ls))
    best = defaultdict(int)
    for (x, _), c in count.items():
        best[x] = max(best[x], c)
    return sorted(((i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(ls),
                    sum(count[p] == best[p[0]] for p in ls), sum(count[p] for p in ls),
                    ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g))
                   for (i, g), ls in zip(per, links)), key=repr)


def got(docs, **options):
    return sorted((tuple(r) for r in align_documents(docs, A, B, **options).collect()), key=repr)


def test_whole_table(small):
    docs, rows = small
    assert got(docs, slices=8) == brute(rows)


def test_odd_texts_ties_and_trees(docs_of):
    texts = ["", None, " ", "  two  spaces ", "end ", " start", "a▁b", "<|endoftext|> and </s>", "x\n \ty \n\nz",
             "café été \U0001f600你好", "café été \U0001f600你好", "a" * 5000, " " * 3000,
             "\x00 \x1c b", "don't  can't", "1234567 89", "  x 　y", "word " * 2000]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(3, "again", "s"), (3, "again", "s"), (None, "no id", "s")]
    expected = brute([(i, t) for i, t, _ in rows])
    docs = docs_of(rows)
    assert got(docs, slices=3) == expected
    # many blocks, several groups a slice, two rounds of the tree
    assert got(docs.withColumnRenamed("source", "payload"), slices=2, block_bytes=8, keys_per_group=8, fan_in=2) == expected


def test_empty_table(docs_of):
    assert got(docs_of([])) == []


def test_words_join_to_the_text():
    for text in ("a b  c", " a", "a ", "a\n b", "a \n b c", "  ", "a  b c"):
        assert "".join(" " + w for w in TwoTokenizers.words(text)) == " " + text


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 40, n))
    made = PerfectHash.of(keys)
    again = PerfectHash.load(made.dump())
    assert sorted(again(keys).tolist()) == list(range(len(keys)))
    assert (made(keys) == again(keys)).all()
    assert len(made.dump()) <= 80 * 4 + len(keys)
