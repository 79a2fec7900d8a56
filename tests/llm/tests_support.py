import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from oracle_compare import differences, oracle_connection  # noqa: E402,F401

WORDS = "the a quick brown fox jumps over lazy dog and then some other animals ran away from big noisy crowd".split()
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, score double, quality int, "
    "found string, fp bigint, component bigint, label int, cell int, base string, added string, pieces string, "
    "n_tokens int, toxicity double, u int, h_id int, privacy_id int, n_words int, kept_id int, kept_key int, "
    "row_key int, doc int, row int"
)
EXTRA = ("x", 1.0, 1, "y", 2, 3, 4, 5, "b", "a", "p", 6, 0.5, 7, 8, 9, 10, 11, 12, 13, 14, 15)


def sentence(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def rows_of(texts):
    """Document rows with clashing extra columns; texts: (doc_id, text, lang)."""
    return [(i, t, lang, "s", None if t is None else len(t), *EXTRA) for i, t, lang in texts]


MESSY = [
    (1, "The quick brown fox.\nIt jumps.", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, " \n\t ", "fr"),
    (5, "word " * 30_000 + "end", "en"),
    (5, "word " * 30_000 + "end", "en"),
    (6, "The quick brown fox.\nIt jumps.", "de"),
    (None, "A text without an id: mail me at a.b@example.org", None),
    (7, "x" * 50_000, "en"),
    (8, "🎉 naïve ça … 日本語", "fr"),
    (9, "1234 5678", None),
]
