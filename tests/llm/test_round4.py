import random

import numpy as np
import public_tokenizers
import pytest

from seqtable.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def counted(encoder):
    """How many words every call of _rounds merges."""
    calls, rounds = [], encoder._rounds
    encoder._rounds = lambda *a: (calls.append(len(a[0])), rounds(*a))[1]
    return calls


def test_a_word_that_comes_up_once_is_merged_once():
    r = random.Random(4)
    words = sorted({"".join(r.choices("etaoinshrdlu", k=r.randint(5, 16))) for _ in range(3000)})
    encoder = pieces.PieceEncoder(MODEL, dropout=0.1)
    calls = counted(encoder)
    ids = encoder(" ".join(words), 1).tolist()
    assert 0.9 * len(words) < sum(calls) <= len(words)  # with all its skips at once, not again after each
    own = encoder._places([1], [len(words)]).tolist()
    assert ids == [i for w, x in zip(words, own, strict=True) for i in encoder.merge(pieces.SPACE + w, encoder._skips(x))[0]]
    # what comes up more often is remembered
    text = "the quick international brown fox " * 400
    encoder(text, 2)
    del calls[:]
    encoder(text, 2)
    assert sum(calls) <= 200 and "▁international" in encoder.roots and "▁" + words[0] not in encoder.roots


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.6, 0.97])
@pytest.mark.parametrize("remembered", [300_000, 100])
def test_occurrences_merged_at_once_are_as_merged_alone(dropout, remembered):
    r = random.Random(5)
    words = ["".join(r.choices("etaoinshrdlué漢😀\0ß%,.", weights=[9] * 12 + [2, 1, 1, 1, 1, 1, 2, 2], k=r.randint(1, 45))) for _ in range(900)]
    texts = [" ".join(r.choices(words, k=1500)) + " " * k + "\n▁ the the" for k in range(4)] + [None, ""]
    encoder = pieces.PieceEncoder(MODEL, dropout, remembered=remembered)
    marks = {w: [encoder.bytes[b] for b in c.encode()] for c, w in encoder.marks.items()}
    for keys in (list(range(6)), list(range(6, 12))):
        for t, k, ids in zip(texts, keys, encoder.encode_many(texts, keys), strict=True):
            cut = encoder._flat(t) if t else []
            places = encoder._places([k], [len(cut)]).tolist()
            want = [i for w, x in zip(cut, places, strict=True) for i in marks.get(w) or encoder.merge(w, encoder._skips(x) if dropout else ())[0]]
            assert ids.tolist() == want and encoder.decode(want) == (t or "")


def test_pairs_of_pieces_are_found_in_their_table():
    encoder = pieces.PieceEncoder(MODEL)
    r = np.random.default_rng(6)
    known = [(encoder.ids[t[:k]], encoder.ids[t[k:]], i) for t, i in encoder.ids.items() for k in range(1, len(t)) if t[:k] in encoder.ids and t[k:] in encoder.ids]
    left, right, made = (np.array(x) for x in zip(*known, strict=True))
    assert (encoder._made(left, right) == made).all()
    all_pairs = set(zip(left.tolist(), right.tolist(), strict=True))
    a, b = r.integers(-2, len(encoder.texts), (2, 200_000))
    assert [(x, y) in all_pairs for x, y in zip(a.tolist(), b.tolist(), strict=True)] == (encoder._made(a, b) > 0).tolist()
