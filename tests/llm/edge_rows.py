"""Rows that every operator is tried on."""

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, places string"

#: Nulls, empty and very long texts, ties, repeated rows, and columns named like the operators' own.
EDGES = [
    (1, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 62, 0.5, "x"),
    (2, None, None, None, None, None, None),
    (None, "a text without an id that has some words in it to count", "en", None, 54, None, "y"),
    (3, "", "en", "a", 0, 1.0, None),
    (4, "   \n\t ", "en", "a", 6, 1.0, None),
    (5, "word " * 60_000, "en", "b", 300_000, 0.0, None),
    (6, "x" * 150_000, "en", "b", 150_000, 0.0, None),
    (7, "tie tie tie\ntie tie tie\nüñî çödé 日本語 😀 <|endoftext|> ▁ a", "fr", "c", 52, 0.0, None),
    (7, "tie tie tie\ntie tie tie\nüñî çödé 日本語 😀 <|endoftext|> ▁ a", "fr", "c", 52, 0.0, None),
    (7, "the same id with another text", "fr", "c", 29, 0.0, None),
    (None, None, None, None, None, None, None),
]
