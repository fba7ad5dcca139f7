"""Small documents and labels with every odd case the corpus operators define."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside; they must not collide with a table's further columns.
CLASHING = "fp long, node string, key string, copies int, shard long, run long, place int, words string, label int, score double, _id long, block long, ids string, owner long, pairs int"


def prose(rng: random.Random, words: int) -> str:
    syllables = "an er the of in re st on ti ou he ha es or nd".split()
    made = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words)]
    lines = [" ".join(made[i : i + 12]) for i in range(0, len(made), 12)]
    return ".\n".join(lines) + "."


def rows() -> list[tuple]:
    """Small documents with every odd case the operators define."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(20, 160)) for _ in range(24)]
    first = texts[0].split(" ")
    texts.append(texts[0])  # exact copy
    texts.append(" ".join([*first[:-1], "changed."]))  # near copy
    texts.append(texts[1] + "\nShared passage of a dozen words that many of the documents hold here.")
    texts.append(texts[2] + "\nShared passage of a dozen words that many of the documents hold there.")
    texts.append("Licensed under the Apache License, Version 2.0.\n" + texts[3])
    texts.append("Released under the MIT License. Released under the MIT License!")
    texts.append("licensed under CC BY-NC 4.0; this work is licensed under the GNU General Public License, version 3")
    texts += [None, "", "  \n\t \r\x0b\x0c ", "one", "two words", "a b c d", "x" * 5000, "é" * 700 + "\n\n" + "▁ <|endoftext|> ▁▁", "tab\there  and　wide space \U0001f600"]
    texts.append("go " * 900 + "stop")  # long and repetitive
    texts.append(prose(rng, 6000))
    texts.append("WOW!! " * 60 + "#### $$$$ | | |")
    out = [(i * 7 if i % 3 else i * 100, t, "en" if i % 2 else None, "web" if i % 3 else None, len(t) if t else None) for i, t in enumerate(texts)]
    out.append(out[5])  # a repeated row
    out.append((out[6][0], "another text under an id that is taken already, with some words", "en", "books", 3))
    out.append((None, texts[4], "en", "books", 9))
    out.append((None, None, None, None, None))
    return out


def labels() -> list[tuple]:
    return [(r[0], int(i % 4 != 0), int(i % 5 == 0)) for i, r in enumerate(rows()) if r[0] is not None and i < 40] + [(None, 1, 0), (3, None, None)]


def vectors() -> list[tuple]:
    """Vectors of 32 components with nulls, non-finite ones, ties, repeats and negative zeros."""
    rng = random.Random(9)
    made = [[round(rng.gauss(0, 0.3), 4) for _ in range(32)] for _ in range(150)]
    out = [(i * 3 - 20, v, i % 4 if i % 5 else None) for i, v in enumerate(made)]
    out += [out[4], (out[5][0], made[7], 1), (-500, [0.0] * 32, 2), (-499, [-0.0] * 32, 2)]
    out += [(900 + i, [x / 256 for x in [i, -i] * 16], None) for i in range(4)]  # ties between entries
    out += [(1000, None, 1), (1001, [float("nan")] + [0.0] * 31, 1), (1002, [None] + [0.0] * 31, 1), (1003, [float("inf")] * 32, 1)]
    out += [(None, made[9], None), (1004, [0.5] * 16, 3), (1005, [70000.0] * 32, 3)]
    return out
