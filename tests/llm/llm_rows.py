"""Rows that every operator must survive: nulls, empty and very long texts, repeated rows, ties."""

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30000))
ODD = [
    (None, None),
    (None, "a b c d e f g"),
    (1, ""),
    (2, "one"),
    (2, "one"),
    (3, " \n\t\n "),
    (4, LONG),
    (5, LONG + " tail"),
    (6, "\n".join(["same line here"] * 30)),
    (7, "é ß 中文 😀 " * 20),
]
