"""Strings on which tokenizers differ easily."""

from __future__ import annotations

import random

FIXED = [
    "", "a", " a", "  a", "a  ", "\n\n a b\t\tc  'd 's don't we'll'll  I'm!'s 'tis 'ReRE 're'", "x<|endoftext|>y  <|startoftext|>", "  <|endoftext|>",
    "日本語 テキスト　x  y z é ﬁ ½ ² Ⅷ", "'", "''s", "it's's", "123abc 4٣", "\x85\x1c\x1d a\x0b\x0c", "😀 😀😀'd", "don'tle 'llama 'vex 've", "ΣΑΣ Σ", "İstanbul", "a﻿b",
]


def odd_strings() -> list[str]:
    rng = random.Random(1)
    letters = " \n\t'stmdrevlaZé1٣!. 　ßİΣςÅé"
    return FIXED + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
