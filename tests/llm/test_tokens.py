"""Word BPE and its lexicon, and the alignment of two tokenizers, against the libraries and brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from millwatch.llm import token_alignment as TA
from millwatch.llm import word_bpe
from millwatch.llm.lexicon import Lexicon, compiled

# --- lexicon ----------------------------------------------------------------------------------------


def test_lexicon_holds_its_words_and_no_others():
    r = random.Random(3)
    words = sorted({bytes(r.choice(b"abc\xff") for _ in range(r.randrange(1, 7))) for _ in range(400)})
    ids = [[r.randrange(1000) for _ in range(r.randrange(4))] for _ in words]
    lexicon = Lexicon(compiled(zip(words, ids)))
    numbers = lexicon.numbers(words)
    assert numbers.tolist() == list(range(len(words)))
    assert [np.frombuffer(x, np.int32).tolist() for x in lexicon.packed(words)] == ids
    others = [w + b"a" for w in words if w + b"a" not in set(words)] + [b"", b"zz", b"a" * 100]
    assert set(lexicon.numbers(others).tolist()) == {-1} and set(lexicon.packed(others)) == {None}
    assert Lexicon(compiled([])).numbers([b"a"]).tolist() == [-1]


def test_lexicon_is_minimal():
    words = sorted(a + b + b"ing" for a in [b"x", b"y", b"zz"] for b in [b"r", b"st"])
    flat = compiled((w, [1]) for w in words)
    rights = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w in words for p in [w[:k] for k in range(len(w) + 1)]}
    assert flat[0] == len(rights)  # one state for each set of endings
    with pytest.raises(ValueError):
        compiled([(b"b", []), (b"a", [])])


# --- word BPE ---------------------------------------------------------------------------------------

TEXTS = [
    None,
    "",
    "   \n\t ",
    "The cat's 3 hats, it'LL do!",
    "<|startoftext|>Hi<|endoftext|> there<|endoftext|>",
    "ΣΑΣ Σ café café İstanbul ǅ",
    "a\x00b\x1cc\x85d\xa0e f",
    "日本語テキスト 😀😀 👩‍👩‍👧",
    "՘ Ɤ \U00010d50x",  # letters of later Unicode versions
    "x" * 5000 + "th" * 3000,
    "<| <|start <|endoftext|",
    "same same same",
    "same same same",
]


@pytest.mark.parametrize("most_words", [0, 5, 100_000])
def test_word_bpe_equals_the_library(documents, clashing, most_words):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(word_bpe.MODEL)
    r = random.Random(5)
    pool = [*"aáb cΣσς'stre12.,!\n<|>é", "'LL", "<|endoftext|>", "in", "the "]
    texts = TEXTS + ["".join(r.choice(pool) for _ in range(r.randrange(60))) for _ in range(150)]
    docs = clashing(documents(*enumerate(texts))).withColumnRenamed("p", "ids").withColumnRenamed("h", "decoded")
    got = word_bpe.decode(word_bpe.encode(docs, most_words=most_words)).collect()
    assert len(got) == len(texts)
    for row in got:
        expected = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert list(row["ids"]) == expected, row["text"]
        assert row["decoded"] == library.decode(expected, skip_special_tokens=False)
        assert row["words"] == "x"
    assert word_bpe.encode(documents()).isEmpty()


def test_merging_by_heap_equals_merging_in_a_list():
    bpe, r = word_bpe.WordBpe(word_bpe.MODEL), random.Random(2)
    for _ in range(300):
        word = bytes(r.choice(b"abehintr") for _ in range(r.randrange(2, 45)))
        ids = [bpe.inner[b] for b in word[:-1]] + [bpe.last[word[-1]]]
        assert bpe._merged_by_heap(ids) == bpe.merged(word)


# --- alignment --------------------------------------------------------------------------------------


def test_diagonals_part_the_merge():
    r = random.Random(4)
    for _ in range(200):
        a, b = (np.cumsum([r.randrange(1, 4) for _ in range(r.randrange(0, 30))]).astype(np.int64) for _ in range(2))
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        for steps in range(len(merged) + 1):
            i, j = TA.diagonal(a, b, steps)
            want = [sum(1 for _, side in merged[:steps] if side == s) for s in (0, 1)]
            parted = 0 < steps < len(merged) and merged[steps - 1][0] == merged[steps][0]
            assert [i, j] == [want[0], want[1] + parted]
        cuts = TA.cut_points(a, b, 5)
        assert all(p >= i and q >= j and (p - i) + (q - j) <= 6 for (i, j), (p, q) in zip(cuts, cuts[1:]))


def aligned_by_hand(texts):
    """Both encodings, groups by a walk over byte offsets, counts by a dictionary."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    first.encode_special_tokens = True
    letters = {c: b for b, c in enumerate(word_bpe.byte_letters())}
    second = sentencepiece.SentencePieceProcessor(model_file=TA.MODEL)
    found, counts = [], Counter()
    for text in texts:
        groups = []
        if text:
            a = first.encode(" " + text, add_special_tokens=False).ids
            b = second.encode(text)
            a_bytes = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
            b_bytes = [bytes([int(second.id_to_piece(i)[1:-1], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                i = j = ended_a = ended_b = 0
                left, right = [], []
                while i < len(a) or j < len(b):
                    if j == len(b) or (i < len(a) and ended_a <= ended_b):
                        left.append(a[i])
                        ended_a += len(a_bytes[i])
                        i += 1
                    else:
                        right.append(b[j])
                        ended_b += len(b_bytes[j])
                        j += 1
                    if left and right and ended_a == ended_b:
                        groups.append((left, right))
                        left, right = [], []
                assert not left and not right
        found.append(groups)
        counts.update((x[-1], y[-1]) for x, y in groups)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    out = []
    for groups in found:
        links = [(x[-1], y[-1]) for x, y in groups]
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        best = sum(counts[p] == highest[p[1]] for p in links)
        out.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links), best, sum(counts[p] for p in links), text))
    return out


@pytest.mark.parametrize("steps, most_pairs", [(TA.STEPS, TA.MOST_PAIRS), (5, 20), (17, 0)])
def test_alignment_equals_a_walk(documents, clashing, steps, most_pairs):
    r = random.Random(6)
    words = ["the", "tionth", " ", "  ", "\n", "é", "日本", "😀", "<s>", "</s>", "<|endoftext|>", "123", "'re", "Inlyin", ".", "▁", "\x00", "́"]
    texts = [None, "", " ", "a", "▁", "same text here", "same text here", "z" * 700, " " * 300 + "x"]
    texts += [" ".join(r.choice(words) if r.random() < 0.3 else r.choice(words[:2]) for _ in range(r.randrange(40))) for _ in range(120)]
    docs = clashing(documents(*enumerate(texts))).withColumnRenamed("h", "groups").withColumnRenamed("n", "pieces")
    got = sorted(TA.align(docs, steps=steps, most_pairs=most_pairs).collect())
    assert [r["doc_id"] for r in got] == list(range(len(texts)))
    for row, want in zip(got, aligned_by_hand(texts), strict=True):
        assert tuple(row)[1:] == want, texts[row["doc_id"]]


def test_alignment_of_nothing_and_of_repeated_rows(documents):
    assert TA.align(documents()).isEmpty()
    got = TA.align(documents((1, "one two"), (1, "one two"), (None, "one")), steps=2).collect()
    assert sorted((r["doc_id"] or 0, r["n_a"]) for r in got) == [(0, 1), (1, 2), (1, 2)]
    assert all(r["count_sum"] > r["n_links"] for r in got)
