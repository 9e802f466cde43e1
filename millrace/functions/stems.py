"""English word stems by the published Porter2 rules, as built-in expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that an English text search leaves out.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its "
    "itself they them their theirs themselves what which who whom this that these those am is are was were be been being "
    "have has had having do does did doing a an the and but if or because as until while of at by for with about against "
    "between into through during before after above below to from up down in out on off over under again further then once "
    "here there when where why how all any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don should now"
).split()

# The rules' own exceptions and endings.
SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
    "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
WHOLE = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]
SECOND = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize",
    "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful",
    "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og",
    "fulli": "ful", "lessli": "less", "li": "",
}
THIRD = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
    "ative": "",
}
FOURTH = "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion".split()

_VOWEL = "[aeiouy]"
# A vowel between consonants, the last not w, x or y; or a vowel that begins the word and one consonant.
_SHORT = "([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"
_REGION = "^.*?[aeiouy][^aeiouy]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body refers to it."""
    return F.transform(F.array(value), body)[0]


def _table(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _ending(word: Column, endings) -> Column:
    """The longest of the endings, or an empty string."""
    return F.regexp_extract(word, f"({'|'.join(endings)})$", 0)


def _cut(word: Column, size: Column | int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - size)


def _cut_ending(word: Column, endings, body: Callable[[Column, Column], Column]) -> Column:
    """``body`` of the longest ending and of the word before it; the word itself if it has none."""
    cut = _let(_ending(word, endings), lambda end: F.when(end == "", word).otherwise(_let(_cut(word, F.length(end)), lambda base: body(end, base))))
    return cut


def _behind(word: Column, start: Column) -> Column:
    """Where the part begins that follows the first consonant behind a vowel, from ``start`` on."""
    found = F.length(F.regexp_extract(F.substring(word, start + 1, F.length(word)), _REGION, 0))
    return _let(found, lambda n: F.when(n > 0, start + n).otherwise(F.length(word)))


def _plural(w: Column) -> Column:
    def cut(end: Column, base: Column) -> Column:
        short = F.when(F.length(w) > 4, F.lit("i")).otherwise(F.lit("ie"))
        out = F.when(end == "sses", F.concat(base, F.lit("ss"))).when(end.isin("ied", "ies"), F.concat(base, short))
        return out.when((end == "s") & base.rlike(f"{_VOWEL}."), base).otherwise(w)

    return _cut_ending(w, ["sses", "ied", "ies", "us", "ss", "s"], cut)


def _past(w: Column, r1: Column, r2: Column) -> Column:
    def cut(end: Column, base: Column) -> Column:
        bare = F.when(base.rlike("(at|bl|iz)$"), F.concat(base, F.lit("e")))
        bare = bare.when(base.rlike("(bb|dd|ff|gg|mm|nn|pp|rr|tt)$"), _cut(base, 1))
        bare = bare.when(base.rlike(_SHORT) & (r1 >= F.length(base)), F.concat(base, F.lit("e"))).otherwise(base)
        long = F.when(F.length(base) >= r1, F.concat(base, F.lit("ee"))).otherwise(w)
        return F.when(end.isin("eed", "eedly"), long).when(base.rlike(_VOWEL), bare).otherwise(w)

    return _cut_ending(w, ["eedly", "ingly", "edly", "eed", "ing", "ed"], cut)


def _final_y(w: Column, r1: Column, r2: Column) -> Column:
    return F.regexp_replace(w, "(?<=.[^aeiouy])[yY]$", "i")


def _second(w: Column, r1: Column, r2: Column) -> Column:
    def cut(end: Column, base: Column) -> Column:
        fits = ((end != "ogi") | base.endswith("l")) & ((end != "li") | base.rlike("[cdeghkmnrt]$"))
        return F.when(fits & (F.length(base) >= r1), F.concat(base, _table(SECOND)[end])).otherwise(w)

    return _cut_ending(w, SECOND, cut)


def _third(w: Column, r1: Column, r2: Column) -> Column:
    def cut(end: Column, base: Column) -> Column:
        fits = F.length(base) >= F.when(end == "ative", r2).otherwise(r1)
        return F.when(fits, F.concat(base, _table(THIRD)[end])).otherwise(w)

    return _cut_ending(w, THIRD, cut)


def _fourth(w: Column, r1: Column, r2: Column) -> Column:
    def cut(end: Column, base: Column) -> Column:
        return F.when((F.length(base) >= r2) & ((end != "ion") | base.rlike("[st]$")), base).otherwise(w)

    return _cut_ending(w, FOURTH, cut)


def _fifth(w: Column, r1: Column, r2: Column) -> Column:
    def cut(end: Column, base: Column) -> Column:
        in_r2 = F.length(base) >= r2
        e = (end == "e") & (in_r2 | ((F.length(base) >= r1) & ~base.rlike(_SHORT)))
        return F.when(e | ((end == "l") & in_r2 & base.endswith("l")), base).otherwise(w)

    return _cut_ending(w, ["e", "l"], cut)


_STEPS = (_past, _final_y, _second, _third, _fourth, _fifth)


def stem(word: Column) -> Column:
    """The stem of a lower-case word.

    Words of one or two letters, and those that hold anything but letters, are their own
    stems; a null word has none.
    """

    def steps(w: Column, r1: Column, r2: Column, at: int) -> Column:
        if at == len(_STEPS):
            return F.lower(w)
        return _let(_STEPS[at](w, r1, r2), lambda v: steps(v, r1, r2, at + 1))

    def of_marked(w: Column) -> Column:
        r1 = F.when(w.rlike("^(gener|arsen)"), 5).when(w.startswith("commun"), 6).otherwise(_behind(w, F.lit(0)))
        both = lambda r1, r2, v: F.when(v.isin(WHOLE), v).otherwise(steps(v, r1, r2, 0))
        return _let(r1, lambda r1: _let(_behind(w, r1), lambda r2: _let(_plural(w), lambda v: both(r1, r2, v))))

    def of_word(w: Column) -> Column:
        # A y that begins the word or follows a vowel is a consonant, written Y.
        marked = F.regexp_replace(F.regexp_replace(w, "^y", "Y"), f"({_VOWEL})y", "$1Y")
        out = F.when((F.length(w) <= 2) | ~w.rlike(r"^\p{L}+$"), w).when(w.isin(list(SPECIAL)), _table(SPECIAL)[w])
        return out.otherwise(_let(marked, of_marked))

    return _let(word, of_word)


def stems(words: Column) -> Column:
    """The distinct stems of a list of words, without stop words."""
    return F.array_distinct(F.transform(F.filter(words, lambda w: ~w.isin(STOP_WORDS)), stem))
