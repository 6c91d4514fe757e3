"""Rows and paths that the tests of this folder share."""

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls, empty and blank texts, a repeated row, repeated texts, a very long text and characters beyond ASCII.
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "no id here at all"), (None, None),
         (7, "Ünïcode ▁ text \U0001F600 end"), (8, LONG), (9, LONG), (10, "a b c d e f g h"), (11, "a b c d e f g h")]
