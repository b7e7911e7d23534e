"""Token expressions, all JVM-side (no Python UDF).

``clean_tokens`` reproduces the word-cloud cleaner of the original job:
null becomes empty, text is lower-cased, every character that is not an ASCII
letter or whitespace becomes a space, the text is split on whitespace and a
token is kept when it is longer than two characters and not a stop word.
(The original also drops all-digit tokens; digits are already gone by then.)
Tokens are therefore maximal runs of ASCII letters of the lower-cased text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES — must equal the original job's stop-word set for identical
# word frequencies. Listed as given there (in that order; "being" appears
# twice in the source list, the set holds 247 distinct words).
_STOP_WORDS_TEXT = """
i me my myself we our ours ourselves you your yours
yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves
what which who whom this that these those am is are
was were be been being have has had having do does
did doing a an the and but if or because as until
while of at by for with through during before after
above below up down in out on off over under again
further then once here there when where why how all
any both each few more most other some such no nor
not only own same so than too very s t can will
just don should now d ll m o re ve y ain aren
couldn didn doesn hadn hasn haven isn ma mightn mustn
needn shan shouldn wasn weren won wouldn really would
could also much well get one way even like time
make made first last back take go see think know
want come look work new good right may say every
little man still life never day another find nothing
tell something fact long great year world might part
place old leave high move try ask show kind hand
head house service friend important lot put end use
become however need seem different number away turn real
perhaps sure without though shall being against thing
between help line set point remember yet problem
game games play played playing player players
"""

STOP_WORDS: tuple[str, ...] = tuple(dict.fromkeys(_STOP_WORDS_TEXT.split()))

MIN_TOKEN_LENGTH = 3  # "longer than two characters"

WHITESPACE_RUN = r"\s+"
NON_LETTER_RUN = r"[^a-z]+"  # applied to lower-cased text


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def raw_tokens(text="review_text") -> Column:
    """Split on runs of whitespace; case and punctuation kept (raw word counts).

    Leading/trailing whitespace yields empty tokens, which are counted.
    """
    return F.split(_col(text), WHITESPACE_RUN)


def token_candidates(text="review_text") -> Column:
    """Maximal runs of ASCII letters of the lower-cased text (null -> empty).

    Replacing every non-letter, non-whitespace character by a space and then
    splitting on whitespace leaves exactly these runs, so one split on
    non-letters gives the same tokens in the same order, in a single regex
    pass. Empty strings at the edges are removed by ``is_kept_token``.
    """
    return F.split(F.lower(F.coalesce(_col(text), F.lit(""))), NON_LETTER_RUN)


def is_kept_token(token) -> Column:
    """Longer than two characters and not a stop word (plain column
    predicate: whole-stage code generation, ``INSET`` lookup)."""
    t = _col(token)
    return (F.length(t) >= MIN_TOKEN_LENGTH) & ~t.isin(*STOP_WORDS)


def clean_tokens(text="review_text") -> Column:
    """The cleaned tokens as an array (for the cleaned text of a review).

    Word frequencies explode ``token_candidates`` and filter with
    ``is_kept_token`` instead: the array lambda here runs interpreted.
    """
    return F.filter(token_candidates(text), is_kept_token)


def clean_text(text="review_text") -> Column:
    return F.array_join(clean_tokens(text), " ")
