"""Texts that several tests use."""

LONG = "word" * 30_000 + " " + " ".join(f"w{i % 977}x{i}" for i in range(60_000))
PROSE = "Rain fell on the slate roofs of the old town while gulls drifted over the harbour wall and boats came home. "
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "kept string, digest int, spans double, _row string, class_id string, n int, node int, key string"
)


def numbered(n: int, salt: str = "") -> str:
    """n words that no other text has."""
    return " ".join(f"{salt}q{i}z" for i in range(n))
