"""The ids of ``packing``: those of the tokenizer itself, each piece encoded once."""

import random

import numpy as np
import public_tokenizers
import pytest

from arealens.llm.packing import _Encoder

ODD = [
    "It's he'll THE'RE o'clock l'eau D'UN ''s !'s 's's x''tx 'sun 'VERY rock'n'roll don't' '1's a'ſ 'été 'É",
    "<|endoftext|> a<|endoftext|>b <|ENDOFTEXT|> X<|Y <| |> < | <|startoftext|>Z.A,b <|EndOfText|>",
    "İstanbul İ H̱. ẖ Å,B Å ≮a ≠ 1́ KING ΑΣ.Α ΣΣ a­b",
    "3.14 12,345 x2y 2x ² 5½ ٣ a1é1 1é 1×2 ÷ Ã×Ã÷a a×B «OUI» “No” it’S",
    "A B\u0085C D　E a\x1cB\x1fC \x7fA\x00B   ​X",
    "中文ABC。 \U0001f600OK! ﬁN ǅUNGLA ȺȾ ɏɐɿʀA " + "".join(map(chr, range(0x100, 0x250))),
    "",
    " \n\t\r\x0b\x0c",
    "!" * 5000 + "Ab" * 5000 + "9" * 300,
    "ÇÁ ÇÀÖØßÞÿ.É,é;(Ü)[ü]{Ä}",
]


@pytest.fixture(scope="module")
def encoder():
    return _Encoder(public_tokenizers.path("word_bpe_49k.json"))


def encoded(encoder, texts):
    raw = [t.encode() for t in texts]
    ids, at = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw])))
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


def own(encoder, texts):
    return [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_ids_are_those_of_the_tokenizer(encoder):
    every = "".join(chr(c) for c in range(0x3000) if c not in range(0xD800, 0xE000))
    texts = ODD + ["x" + c + "Y'" + c + " " + c + "'s" + c + "1" + c + c.upper() + "." + c for c in every]
    assert encoded(encoder, texts) == own(encoder, texts)


def test_ids_of_mixed_characters(encoder):
    rng = random.Random(5)
    signs = list("aAsStTlLeEdDrRvVmM'''..,!<|> \n19éÉ×÷İı̸̱̀̇ «’Σ中ſK") + ["<|endoftext|>", "<|", "'re", "'LL"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(30))) for _ in range(20_000)]
    assert encoded(encoder, texts) == own(encoder, texts)


def test_pieces_are_encoded_once_whatever_stands_around_them():
    encoder = _Encoder(public_tokenizers.path("word_bpe_49k.json"))
    words = ["tower", "été", "bridge"]
    texts = [f"{a}{w}{b} {w.capitalize() if w.isascii() else w}{b}" for w in words for a in ("", "(", '"', "#", "<") for b in (".", ",", "!?", ")", "'", ";;")]
    assert encoded(encoder, texts) == own(encoder, texts)
    assert len(encoder.pool.first) <= len(words) + 4 + 6
