"""Small inputs with every awkward case: nulls, ties, repeats, long and empty texts, clashing columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, shard int, epoch int, _key long, row string"


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    made = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ra", "si", "to", "ve", "zu")
            for b in ("dan", "fer", "gil", "hom", "jun", "kel", "lap", "mor", "nis", "pod", "qua", "rim", "sol", "tev",
                      "und", "vax", "wen", "xil", "yor", "zab", "bre", "cli", "dro", "fli", "gra", "hul", "ipo", "jek",
                      "kro", "lim", "mup", "nol", "ost", "pri", "qes", "rud", "ska", "tho", "ulm", "vor")][:vocabulary]
    return " ".join(rng.choice(made) for _ in range(n))


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, len(text or ""), 7, True, 3, 1, 9, "r")


def awkward(rng=None) -> list[tuple]:
    rng = rng or random.Random(5)
    base = prose(rng, 120)
    return [
        row(1, base), row(2, base), row(3, base + " tail"),                      # copies and a near copy
        row(4, None, None, None), row(5, ""), row(6, " \t\n "), row(7, "one"),   # nothing or almost nothing
        row(8, "One"), row(9, prose(rng, 9000)),                                 # ties after lower-casing, a long text
        row(10, "x" * 30_000), row(11, "la " * 3000),                            # one long word, one repeated word
        row(12, prose(rng, 40)), row(12, prose(rng, 40)),                        # one doc_id, two texts
        row(13, "same row twice here"), row(13, "same row twice here"),          # a repeated row
        row(None, base), row(None, "no id " + prose(rng, 30)), row(None, None, None, None),
        row(14, "Ünïcödé ß İ K ñ 日本語 é   mit license"), row(15, base.upper()),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)
