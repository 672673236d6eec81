"""Company names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal-entity endings that are not part of a name. Single letters come with points
# or, as one word, without; words of an ending may be apart by blanks, points and commas.
LEGAL_ENDINGS = (
    "ab", "ag", "aps", "as", "asa", "bv", "co", "company", "corp", "corporation",
    "gmbh", "inc", "incorporated", "kg", "kk", "limited", "llc", "llp", "lp", "ltd",
    "ltda", "nv", "oy", "oyj", "plc", "pte", "pty", "sa", "sarl", "srl", "spa",
    "a s", "b v", "d o o", "e v", "k k", "l l c", "l l p", "l p", "n v", "p l c", "s a",
    "s a r l", "s a s", "s p a", "s r l", "s r o", "a/s", "e k", "eg", "kgaa", "mbh", "ohg", "pvt", "se", "ug",
    "ag & co kg", "gmbh & co kg", "gmbh & co ohg", "gmbh & co kgaa", "& co", "and company", "& company",
    "sp z o o", "sp j", "s de r l de c v", "s a de c v", "sdn bhd", "co ltd", "private limited",
    "public limited company", "limited liability company", "limited partnership", "joint stock company",
)


def _branches(endings: list[list[str]]) -> dict:
    """A trie of endings from their last word on; the key None marks a first word."""
    root: dict = {}
    for words in endings:
        node = root
        for word in reversed(words):
            node = node.setdefault(word, {})
        node[None] = True
    return root


def _between(word: str) -> str:
    """What stands between a word of an ending and the next one: after a letter a point, but for z."""
    return "[.] ?" if len(word) == 1 and word.isalpha() and word != "z" else "[., ]*[., ]"


def _pattern(node: dict) -> str:
    """The endings of a trie as one expression: what is in front of a word comes before it."""
    out = []
    for word in sorted((w for w in node if w is not None), key=lambda w: (-len(w), w)):
        below = node[word]
        front = sorted(((_pattern({w: below[w]}), _between(w)) for w in below if w is not None), key=lambda x: (-len(x[0]), x))
        before = "|".join(f"{p}{gap}" for p, gap in front)
        if before:
            before = f"(?:{before})" + ("?" if None in below else "")
        out.append(before + word)
    return "|".join(out) if len(out) == 1 else f"(?:{'|'.join(out)})"


ENDINGS = _pattern(_branches([e.split() for e in LEGAL_ENDINGS]))
# Any run of endings, then blanks and commas, up to the end of the name; and nothing but endings.
ENDING_PATTERN = f"(?i)([ ,]+{ENDINGS}[.]?)*[ ,]*$"
ONLY_ENDINGS = f"(?i)^{ENDINGS}[.]?([ ,]+{ENDINGS}[.]?)*[ ,]*$"


def base_name(name: Column) -> Column:
    """The name without trailing legal-entity endings, blanks and commas.

    Endings may have several words and points within; several in a row all go. A name that is
    only endings stays.
    """
    whole = F.trim(name)
    return F.when(whole.rlike(ONLY_ENDINGS), whole).otherwise(F.regexp_replace(whole, ENDING_PATTERN, ""))
