"""Rows that the operators must handle: nulls, empty and long texts, copies, repeated rows."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns under the operators' own working names.
CLASH = {"key": "k", "c": 1, "n": 2, "h": "x", "norm": "y", "size": 3, "target": 0.5, "kept": True, "label": "z", "id": 9, "sk": "s",
         "score": 1.0, "toxic": 5, "y": 6, "sketch": "t", "rep": 7, "r": 8}


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 7))) for _ in range(n))


def edge_rows() -> list[tuple]:
    base = prose(1, 300).split()
    edited = base.copy()
    edited[150] = "CHANGED"
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\r\n", None, None, None), (4, "one two", "en", "b", 7),
        (5, "One\ttwo", "en", "b", 7), (6, "one two three four five six", "en", "b", 1), (7, " ".join(base), "en", "a", 1),
        (8, " ".join(base).upper(), "en", "a", 1), (9, " ".join(edited), "en", "a", 1), (10, " ".join(base[100:200]), "de", "c", 1),
        (11, prose(2, 60_000), "en", "c", 1), (12, "wort " * 500, "de", "c", 1), (13, "wort " * 501, "de", None, 1),
        (14, "café naïve 中文 \U0001f600 x\u0085y", "fr", "a", 1), (None, prose(3, 80), "en", "a", 1), (None, prose(3, 80), "en", "a", 1),
        (15, prose(4, 50), "en", "d", 1), (15, prose(4, 50), "en", "d", 1), (16, prose(5, 40) + "\n" + " ".join(base[:60]), None, "a", 1),
        (17, "same line here again and again for all", "en", "a", 1), (18, "same line here again and again for all", "en", "z", 2),
    ]
    return rows
