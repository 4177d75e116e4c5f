"""Language of a text from its function words.

The small words of a language make up a third or more of any prose in it, so
counting them tells languages apart without a model (Grefenstette, "Comparing
two language identification schemes", 1995).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Frequent function words by language code.
FUNCTION_WORDS = {
    "de": ("der die das und ist nicht ein eine mit von den dem auf für sich im als auch zu wird"),
    "en": ("the of and to in is that it was for with as are on by this from not be or"),
    "es": ("el la de que y los las un una por con para del se no es en como más su"),
    "fr": ("le la les de des du et est un une que dans pour qui sur pas avec au ce il"),
    "ha": ("da na ba ne ce shi ta su ya wanda don kuma amma cikin wannan yana suna daga zuwa mai"),
    "ig": ("na nke ndị bụ ya ha onye dị maka ka ihe nwere site mgbe gị anyị ahụ dịka banyere ma"),
    "pcm": ("dey wey don di wetin dem una sabi abi no go na im make sey am for fit get dat"),
    "yo": ("ni ti àwọn àti náà bí kí sí fún wọn ṣe yìí pé láti gbogbo kò jẹ lọ wá ń"),
}


CODES = tuple(sorted(FUNCTION_WORDS))
WORD_BREAK = r"[^\p{L}\p{M}]+"


def function_words(text: Column) -> Column:
    """The function words of any language that occur in the text, repeats kept."""
    every = sorted({w for words in FUNCTION_WORDS.values() for w in words.split()})
    return F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w.isin(*every))


def hit_counts(found: Column) -> dict[str, Column]:
    """How many of the :func:`function_words` belong to each language."""

    def among(words: list[str]) -> Column:
        return F.size(F.filter(found, lambda w: w.isin(*words))).cast("bigint")

    return {code: among(FUNCTION_WORDS[code].split()) for code in CODES}


def best_language(hits: dict[str, Column]) -> Column:
    """Code with the most hits, the first in alphabetical order on a tie, else ``unknown``."""
    most = F.greatest(*hits.values())
    choice = F.when(most == 0, F.lit("unknown"))
    for code in CODES:
        choice = choice.when(hits[code] == most, F.lit(code))
    return choice


def confidence(hits: dict[str, Column]) -> Column:
    """The winner's share of all hits, null without any."""
    total = sum(hits.values(), F.lit(0))
    return F.round(F.try_divide(F.greatest(*hits.values()), total), 4)
