import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from rosterlake.llm.pieces import CharacterMap, PieceModel, _fields, decode, encode, load

from odd_rows import documents, empty, ODD_TEXTS  # noqa: F401  (fixtures)

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def tricky(n=400):
    rng = random.Random(5)
    letters = "ab  ▁\n\t\r<s>é☃😀́\x00 0x0A>1234.,!é漢'"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 40))) for _ in range(n)]


def test_ids_and_texts_equal_the_library(documents, empty):
    texts = ODD_TEXTS + tricky() + ["<s>", "</s> <unk>", "   ", "a" * 3000 + " b"]
    docs = documents([(i, t) for i, t in enumerate(texts)] + [(None, "x")], extra=("ids", "decoded"))
    got = {r.doc_id: r for r in decode(encode(docs, PATH), PATH).collect()}
    assert len(got) == len(texts) + 1
    for i, text in enumerate(texts):
        want = LIBRARY.encode(text or "")
        raw = (text or "").encode()
        assert got[i].ids == want and got[i].decoded == LIBRARY.decode(want), (i, text and text[:50])
        # Spans cover the original bytes in order, each byte once.
        assert got[i].begins == ([0, *got[i].ends[:-1]] if want else [])
        assert not want or got[i].ends[-1] == len(raw)
        for piece, a, b in zip(LIBRARY.encode(text or "", out_type=str), got[i].begins, got[i].ends):
            if not piece.startswith("<0x"):
                assert raw[a:b].decode().replace(" ", "▁") in (piece, piece[1:])
    assert encode(empty, PATH).count() == 0


def test_signs_among_letters_keep_the_marks_that_pieces_join_to_them():
    rng, model = random.Random(9), load(PATH)
    texts = ["m².", "km². And", "area².x", ".²a", "²", "x² .", "½.a", "m³.", "a.²"]
    texts += ["".join(rng.choice("am².³½¹ ,:_0é") for _ in range(rng.randrange(1, 12))) for _ in range(2000)]
    ids, ends, _ = model.encode_plain(texts)
    for text, a, b in zip(texts, ends[:-1], ends[1:]):
        assert ids[a:b].tolist() == LIBRARY.encode(text), text
    # Every neighbourhood inside a piece, in the middle of letters.
    inside = ["ab" + p.replace("▁", " ") + "cd" for p in model.ids if not p.isalpha()]
    ids, ends, _ = model.encode_plain(inside)
    for text, a, b in zip(inside, ends[:-1], ends[1:]):
        assert ids[a:b].tolist() == LIBRARY.encode(text), text


def test_a_character_map_normalises_like_the_library():
    def normaliser(squeeze):
        return sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=False, escape_whitespaces=False,
                                                     remove_extra_whitespaces=squeeze)

    library = normaliser(False)
    spec = dict(_fields(next(v for k, v in _fields(library.serialized_model_proto()) if k == 3)))
    model = PieceModel(open(PATH, "rb").read())
    model.map, model.prefix, model.squeeze, model.escape = CharacterMap(spec[2]), False, False, False
    rng = random.Random(6)
    letters = "ａ①ｱﾞ é́e　\tＡb ﬁ½㌔­한가​z"
    for squeeze in (False, True):
        model.squeeze = squeeze
        library = normaliser(squeeze)
        for _ in range(300):
            text = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 15)))
            shown, origin = model.normalise(text)
            assert shown == library.normalize(text), repr(text)
            assert len(origin) == len(shown.encode()) + 1 and origin == sorted(origin) and origin[-1] <= len(text.encode())


@pytest.mark.parametrize("seed", [1, 2])
def test_any_ids_decode_like_the_library(seed):
    rng, model = random.Random(seed), load(PATH)
    for _ in range(500):
        ids = [rng.choice([rng.randrange(300), rng.randrange(32000)]) for _ in range(rng.randrange(0, 8))]
        assert model.decode(np.array(ids, np.int64), np.array([0, len(ids)]))[0] == LIBRARY.decode(ids), ids


def test_long_stretches_merge_like_short_ones():
    model, rng = load(PATH), random.Random(8)
    for n in (60, 64, 65, 70, 300):
        text = "".join(rng.choice("thesandolmq") for _ in range(n))
        assert model.merge(text) == model._merge_short(list(text))


def test_digest_columns(spark, documents):
    from rosterlake.llm import pieces

    row = encode(documents([(1, "hello world")]), PATH).select("ids", pieces.digest(pieces.F.col("ids")).alias("d")).first()
    assert row.d == hashlib.sha256(",".join(map(str, row.ids)).encode()).hexdigest()
