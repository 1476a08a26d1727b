"""Regular expressions and labels shared by the operators.

Fixed values: results only agree with existing corpora when these stay as
they are.  Patterns are in Java spelling; ``(?U)`` makes ``\\b``, ``\\d`` and
``\\w`` follow Unicode.
"""

# The 29 code points Python's Unicode-aware \s matches.
WHITESPACE = (
    r"[\s\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)
# All of them but the space.  Each below 256 is spelled out and the others lie in one range, so that
# Java decides on nearly every character by one look-up and one comparison.
OTHER_SPACE = (
    r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"
)

CONTROL_INTENT = r"\p{Cc}"
# One of {control character, & [ ^ newline tab} followed by a closing bracket.
CONTROL_PARITY = r"[\p{Cc}&\[\^\n\t]\]"

# $-_ is a range: it takes in / : ; < = > ? but neither # nor ~.
URL = r"https?://[a-zA-Z0-9$-_@.&+!*\\(),]+"
EMAIL = r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE = r"(?U)\b\d{3}[-.]?\d{3}[-.]?\d{4}\b"
SSN = r"(?U)\b\d{3}-\d{2}-\d{4}\b"

EMAIL_SCORE = 0.9
PHONE_SCORE = 0.8
SSN_SCORE = 0.9

# A word is a run of word characters or a run of marks between them.
WORD = r"(?U)\w+|[^\w\s]+"

SPECIAL_TOKENS = ("<pad>", "<s>", "</s>", "<unk>", "<mask>")
CONTINUATION = "##"

LSH_BANDS = 16
