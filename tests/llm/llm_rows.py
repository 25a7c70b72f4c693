"""Rows that several tests of this folder use."""

SF_DIR = "/root/testdata/sf0.001"
WORDS = "amber birch cedar dune ember fjord grove heath islet jetty knoll larch mesa north orchid prairie quartz ridge spruce tundra"


def prose(seed: int, n: int) -> str:
    """``n`` words that no other seed repeats in a row."""
    base = WORDS.split()
    return " ".join(f"{base[(i * 7 + seed) % 20]}{(i * i + seed * 31) % 9973}" for i in range(n))


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept string, fp long"
LONG = prose(5, 30_000)
ODD_ROWS = [
    (1, None, None, None, None, None, None, None),
    (2, "", "en", "s", 0, 1, "x", 2),
    (3, " \t\n", "en", "s", 3, 1, "x", 2),
    (4, prose(1, 80), "en", "s", 1, 1, "x", 2),
    (4, prose(1, 80), "en", "s", 1, 1, "x", 2),
    (None, prose(2, 80), "de", None, 1, None, None, None),
    (6, LONG, "en", "s", 1, 1, "x", 2),
    (7, prose(1, 80), "en", "s", 1, 1, "x", 2),
    (8, "été \U0001F600 üß 日本語", "fr", "s", 1, 1, "x", 2),
]
