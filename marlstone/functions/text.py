"""Text expressions: cleaning, tokens, stop words, aspects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the public English stop word list (letters only) -----------
# Apostrophes are removed before the words are matched, so the list holds no
# contracted forms with an apostrophe.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his "
    "himself she her hers herself it its itself they them their theirs themselves what "
    "which who whom this that these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of at by for "
    "with about against between into through during before after above below to from up "
    "down in out on off over under again further then once here there when where why how "
    "all any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don should now d ll m o re ve y ain aren couldn didn doesn "
    "hadn hasn haven isn ma mightn mustn needn shan shouldn wasn weren won wouldn"
).split()

# --- fixed values: keywords of the eleven climate aspects ---------------------
CLIMATE_ASPECTS = {
    "renewables": [
        "renewable", "solar", "wind", "hydro", "clean energy", "green energy",
        "photovoltaic", "geothermal", "biomass", "offshore wind", "onshore wind",
        "green hydrogen", "electrification",
    ],
    "fossil_fuels": [
        "oil", "gas", "coal", "fossil fuels", "drilling", "extraction", "petroleum",
        "natural gas", "fracking", "offshore drilling", "oil sands",
    ],
    "emissions": [
        "carbon", "emissions", "co2", "carbon dioxide", "net zero", "carbon neutral",
        "greenhouse gases", "methane", "carbon capture", "ghg", "emission cuts",
    ],
    "policy": [
        "regulation", "carbon tax", "emissions trading", "climate policy", "agreement",
        "paris accord", "environmental law", "legislation", "cop26", "policy change",
        "climate regulation",
    ],
    "climate_transition": [
        "transition", "decarbonization", "climate action", "climate strategy",
        "sustainability", "net-zero targets", "climate goals", "transition risk",
    ],
    "energy_efficiency": [
        "efficiency", "supercomputers", "energy efficiency", "smart grid",
        "digital energy", "building efficiency", "industrial efficiency",
        "retrofitting", "insulation",
    ],
    "climate_risk": [
        "climate risk", "transition risk", "physical risk", "climate-related risks",
        "risk disclosure", "climate threat",
    ],
    "finance_investment": [
        "green bonds", "sustainable finance", "climate finance", "green investment",
        "esg", "carbon credit", "divestment", "stranded assets", "climate disclosure",
    ],
    "transportation": [
        "electric vehicles", "ev", "battery storage", "charging stations",
        "vehicle emissions", "hybrid", "sustainable transport", "biofuels",
        "clean transport",
    ],
    "climate_impact": [
        "climate change", "global warming", "rising temperatures", "climate crisis",
        "warming planet", "sea level rise", "extreme weather", "melting glaciers",
        "heatwaves", "drought", "flooding",
    ],
    "climate_innovation": [
        "innovation", "green tech", "carbon removal", "direct air capture",
        "climate technology", "clean technology", "energy storage", "green startups",
    ],
}

# --- fixed values: class names of the two text scorers ------------------------
SPECIFICITY_LABELS = {1: "yes", 0: "no"}
SENTIMENT_LABELS = {0: "risk", 1: "neutral", 2: "opportunity"}

# Whitespace in the Unicode sense; the regex class ``\s`` alone covers ASCII only.
_SPACE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE_CHARACTERS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)


def _letters(text: Column) -> Column:
    # The look-ahead says nothing new; it passes over most characters by a short class.
    return F.lower(F.regexp_replace(text, rf"(?![a-zA-Z ])[^a-zA-Z{_SPACE}]", ""))


def clean_text(text: Column) -> Column:
    """ASCII letters and whitespace only, lower case, no outer whitespace."""
    return F.btrim(_letters(text), F.lit(_SPACE_CHARACTERS))


def tokens(cleaned: Column) -> Column:
    """Runs of letters of a cleaned text."""
    return F.regexp_extract_all(cleaned, F.lit("[a-z]+"), F.lit(0))


def remove_stopwords(words: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Drop listed words; repeats of the others stay, in order."""
    stops = list(stop_words)
    return F.filter(words, lambda word: ~word.isin(stops))


def normalize(text: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Clean, tokenise, drop stop words and rejoin with single blanks."""
    return F.concat_ws(" ", remove_stopwords(tokens(_letters(text)), stop_words))


def extract_field(json_or_text: Column, name: str) -> Column:
    """The named field of a JSON object ('' where it lacks the field), else the text itself.

    Only what parses as a JSON object is one: a text that merely begins with a brace stays.
    """
    looks_so = json_or_text.rlike(r"^\s*\{")
    # The parser stops after the first value. In an array before a number of the text's
    # own, the text is a single object just where that number is the second entry.
    mark = F.xxhash64(json_or_text)
    wrapped = F.concat(F.lit("["), json_or_text, F.lit(","), mark.cast("string"), F.lit("]"))
    record = F.when(looks_so, F.try_parse_json(wrapped))
    is_object = F.coalesce(F.try_variant_get(record, "$[1]", "bigint") == mark, F.lit(False))
    field = F.coalesce(F.try_variant_get(record, f"$[0]['{name}']", "string"), F.lit(""))
    return F.when(is_object, field).otherwise(json_or_text)


def lengths_match(a: Column, b: Column) -> Column:
    return F.size(a) == F.size(b)


def tag_aspects(
    text: Column,
    aspects: Mapping[str, Sequence[str]] = CLIMATE_ASPECTS,
    mode: str = "substring",
) -> Column:
    """Sorted array of the aspects with a keyword in the text.

    ``substring`` matches inside words too ("oil" in "soil"); ``word`` matches
    whole words or word sequences of a text joined by single blanks.
    """
    if mode not in ("substring", "word"):
        raise ValueError(f"unknown mode: {mode!r}")
    pad = "" if mode == "substring" else " "
    haystack = F.concat(F.lit(pad), text, F.lit(pad)) if pad else text

    def tag(aspect):
        padded = [f"{pad}{keyword}{pad}" for keyword in aspects[aspect]]
        # A keyword that holds another one of its aspect cannot add a match.
        needed = [k for k in padded if not any(o != k and o in k for o in padded)]
        hit = haystack.contains(needed[0])
        for keyword in needed[1:]:
            hit = hit | haystack.contains(keyword)
        return F.when(hit, F.lit(aspect))

    return F.array_compact(F.array(*[tag(aspect) for aspect in sorted(aspects)]))
