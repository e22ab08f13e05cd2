"""Tag and text functions, all as Column expressions except the two that need Python (fuzzy_ratio, lenient JSON)."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom import rules

DASHES = "—–―−"
QUOTES = "“”‘’\"'"


def let(value: Column, f) -> Column:
    """f(value) with value evaluated once, however often f uses it."""
    return F.transform(F.array(value), f)[0]


def fold_dashes(text: Column) -> Column:
    return F.translate(text, DASHES, "----")


def normalize_tag(text: Column) -> Column:
    """Extraction form: upper case, inches as IN, tidy hyphens, a lone leading letter joined by a hyphen, single spaces."""
    t = F.upper(F.trim(text))
    t = F.regexp_replace(t, "([0-9]+(?:\\.[0-9]+)?)\\s*(?:''|\"|´´|′′|″|”|’’)", "$1IN")
    t = F.regexp_replace(t, r"\s*-\s*", "-")
    t = F.regexp_replace(t, r"^([A-Z])\s+([A-Z])", "$1-$2")
    t = F.regexp_replace(t, r"-{2,}", "-")
    t = F.trim(F.regexp_replace(t, r"\s+", " "))
    return F.regexp_replace(t, "^-+|-+$", "")


#: The steps of the canonical form: label, rewrite.
CANONICAL_STEPS: list[tuple[str, object]] = [
    ("ocr_char_fix", lambda t: F.translate(t, "–—− \t", "---  ")),
    ("inch_normalised", lambda t: F.regexp_replace(t, "([0-9])\\s*[\"”“]", "$1IN")),
    ("uppercased", F.upper),
    ("separators_normalised", lambda t: F.regexp_replace(t, r"[\s./_\\]+", "-")),
    ("collapsed_hyphens", lambda t: F.regexp_replace(t, "-{2,}", "-")),
    ("illegal_chars_removed", lambda t: F.regexp_replace(t, '[^A-Z0-9\\-"]', "")),
    ("leading_trailing_hyphens_stripped", lambda t: F.regexp_replace(t, "^-+|-+$", "")),
]


def canonical_tag(df: DataFrame, text: str, out: str = "canonical_tag", log: str = "transforms") -> DataFrame:
    """df with the canonical form of a tag and the labels of the steps that changed it ("no_change", or "empty_input")."""
    steps = [f"__t{i}" for i in range(len(CANONICAL_STEPS) + 1)]
    df = df.withColumn(steps[0], F.trim(F.col(text)))
    for (_, rewrite), before, after in zip(CANONICAL_STEPS, steps[:-1], steps[1:], strict=True):
        df = df.withColumn(after, rewrite(F.col(before)))
    marks = F.array_compact(F.array(*[F.when(F.col(a) != F.col(b), label) for (label, _), b, a in zip(CANONICAL_STEPS, steps[:-1], steps[1:], strict=True)]))
    empty = F.col(text).isNull() | (F.col(text) == "")
    told = F.when(empty, F.array(F.lit("empty_input"))).when(F.size(marks) == 0, F.array(F.lit("no_change"))).otherwise(marks)
    return df.withColumn(out, F.when(empty, "").otherwise(F.col(steps[-1]))).withColumn(log, told).drop(*steps)


def _bare(text: Column, strip: str) -> Column:
    folded = fold_dashes(F.upper(F.trim(F.coalesce(text, F.lit("")))))
    return F.regexp_replace(F.regexp_replace(folded, strip, ""), "IN", "")


def dedup_key(text: Column) -> Column:
    """Upper case without spaces, hyphens, dots and quotes, and without every IN."""
    return _bare(text, f"[\\s\\-.{QUOTES}]+")


def eval_key(text: Column) -> Column:
    """As dedup_key, but dots stay and backticks go."""
    return _bare(text, f"[\\s\\-`{QUOTES}]+")


def registry_key(text: Column) -> Column:
    return _bare(text, f"[\\s\\-.{QUOTES}]+")


def registry_key_without_area(text: Column) -> Column:
    return F.regexp_replace(registry_key(text), "^[A-Z]", "")


def fold_confusable(text: Column) -> Column:
    return F.translate(text, "01", "OI")


def legacy_normalize(text: Column) -> Column:
    t = F.regexp_replace(F.upper(F.trim(text)), r"[\s.]+", "-")
    return F.regexp_replace(F.regexp_replace(t, "-+", "-"), "^-+|-+$", "")


def strip_area_prefix(text: Column) -> Column:
    return F.regexp_replace(text, "^[A-Z]+-", "")


def is_false_positive(text: Column) -> Column:
    t = F.trim(F.coalesce(text, F.lit("")))
    return (F.length(t) < 3) | t.rlike(rules.DRAWING_REFERENCES) | t.rlike(rules.BARE_LABELS)


def is_line_number(text: Column) -> Column:
    return F.coalesce(F.trim(text).rlike(rules.LINE_NUMBER), F.lit(False))


def is_instrument_tag(text: Column) -> Column:
    t = F.translate(F.coalesce(text, F.lit("")), "—–", "--")
    return (F.length(t) >= 3) & ~t.rlike(rules.PIPE_SPEC) & ~F.trim(t).rlike("^[0-9]+$") & t.rlike(rules.INSTRUMENT_TAG)


def is_equipment_tag(text: Column) -> Column:
    t = F.upper(F.trim(F.coalesce(text, F.lit(""))))
    return t.rlike(rules.EQUIPMENT_TAG) & ~t.isin("UNKNOWN", "NONE")


def is_piping_node(kind: Column, text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return F.coalesce(kind == "piping", F.lit(False)) | t.rlike(rules.PIPE_SPEC) | t.rlike('(?i)^[0-9]+(IN|")-')


def tag_format(text: Column) -> Column:
    """struct(pass, rule, message) of the format check."""
    t = F.translate(F.trim(F.coalesce(text, F.lit(""))), DASHES + "“”’", "----\"\"'")

    def told(x: Column) -> Column:
        message = (
            F.when(x["t"] == "", "Empty or null tag text")
            .when(x["name"].isNotNull(), F.concat(F.lit("Matches ISA pattern: "), x["name"]))
            .when(x["t"].rlike(rules.BASIC_FORMAT), "Matches basic prefix-number format")
            .otherwise(F.concat(F.lit("Does not match ISA-5.1 format: '"), x["t"], F.lit("'")))
        )
        return let(message, lambda m: F.struct(m.startswith("Matches").alias("pass"), F.lit("TAG_FORMAT").alias("rule"), m.alias("message")))

    return let(t, lambda x: let(F.struct(x.alias("t"), rules.first_match(x, rules.TAG_FORMATS).alias("name")), told))


def discipline(canonical: Column, category: Column) -> Column:
    """By function code (last part, first part, whole prefix; codes in order), then category, then size."""
    prefix = F.regexp_replace(F.regexp_extract(canonical, "^([A-Z-]{1,8})", 1), "^-+|-+$", "")
    codes = F.array(F.element_at(F.split(prefix, "-"), -1), F.get(F.split(prefix, "-"), F.lit(0)), prefix)
    case = None
    for names, out in rules.DISCIPLINES:
        hit = F.arrays_overlap(codes, F.array(*[F.lit(n) for n in names]))
        case = F.when(hit, out) if case is None else case.when(hit, out)
    c = F.lower(F.coalesce(category, F.lit("")))
    return case.when(c == "instrument", "INSTRUMENTATION").when(c.isin("valve", "equipment"), "MECHANICAL").when(c == "piping", "PIPING").when(canonical.rlike('^[0-9]+["\\-]'), "PIPING").otherwise("MECHANICAL")


def legacy_discipline(tag: Column) -> Column:
    """By tag alone, the first of six rules; anything else is instrumentation."""
    t = F.upper(F.coalesce(tag, F.lit("")))
    return (
        F.when(t.rlike("^(V-)?(K|KG|S)-V-"), "MECHANICAL")
        .when(t.rlike("^(V-)?KM-V-"), "ELECTRICAL")
        .when(t.rlike("^(V-)?V-V-"), "MECHANICAL")
        .when(t.rlike("^(V-)?(BV|GV|RV|NRV|GLV|FCV|PCV|TCV|LCV)-"), "MECHANICAL")
        .when(t.rlike('^[0-9]{1,2}(IN)?["-]'), "PIPING")
        .otherwise("INSTRUMENTATION")
    )


def descriptions(symbol: Column, canonical: Column, context: Column, reg_description: Column, reg_equipment: Column) -> Column:
    """struct(tag_description, equipment_description): register, then context, then ontology, then the tag itself."""
    name = F.coalesce(symbol, F.lit(""))
    reg, ctx = F.trim(F.coalesce(reg_description, F.lit(""))), F.trim(F.coalesce(context, F.lit("")))
    own = F.when(name != "", name).otherwise(canonical)
    equip, prefix = rules.first_match(name, rules.ONTOLOGY), rules.first_match(name, rules.ONTOLOGY, 2)
    tag = F.when(reg != "", reg).when(ctx != "", ctx).when(prefix.isNotNull(), F.concat(prefix, F.lit(","), F.element_at(F.split(canonical, "-"), -1))).otherwise(canonical)
    unit = F.when(reg != "", F.trim(F.coalesce(reg_equipment, F.lit("")))).when(ctx != "", own).otherwise(F.coalesce(equip, own))
    return F.struct(F.upper(tag).alias("tag_description"), F.upper(unit).alias("equipment_description"))


def doc_status(revision: Column, issue: Column) -> Column:
    code = F.upper(F.trim(F.coalesce(revision, F.lit(""))))
    known = F.create_map(*[F.lit(x) for kv in rules.DOC_STATUS.items() for x in kv])
    return F.when(F.length(F.trim(issue)) > 3, F.upper(F.trim(issue))).otherwise(F.coalesce(F.try_element_at(known, code), F.when(code != "", F.concat(F.lit("REVISION "), code)).otherwise("ACTIVE")))


def canonical_id(project: Column, tag: Column, drawing: Column) -> Column:
    return F.upper(F.substring(F.sha2(F.concat_ws("|", project, tag, drawing), 256), 1, 12))


def tag_prefix(text: Column) -> Column:
    return F.regexp_extract(text, "^([A-Z]{1,4})", 1)


def instrument_family(tag: Column) -> Column:
    """What an instrument measures, by its leading letters after V's and hyphens; any T is temperature, no known letters are null."""
    t = F.regexp_replace(F.upper(F.coalesce(tag, F.lit(""))), "^V*-*", "")
    return F.when(t.startswith("T"), "temperature").when(t.rlike("^(PAHH|PIT|PI)"), "pressure").when(t.rlike("^(LIT|LI)"), "level").when(t.rlike("^(FIC|FIT|FI)"), "flow")


def loop_role(tag: Column) -> Column:
    """By the leading letters after V's and hyphens, the first rule that holds: C a controller, IT or a last T a transmitter, a last or early E an element, then valves."""
    letters = F.regexp_extract(F.regexp_replace(F.upper(F.coalesce(tag, F.lit(""))), "^[V-]+", ""), "^([A-Z]+)", 1)
    return (
        F.when(letters.contains("C"), "controller")
        .when(letters.rlike("IT|T$"), "transmitter")
        .when(letters.rlike("E$|^.?E"), "element")
        .when(letters.rlike("^(FV|FCV|PV|TV|LV|ZV|XV|BV|GV)"), "valve")
        .otherwise("other")
    )


def functional_location(parts: Column) -> Column:
    """Labels joined by dots; a label equal to the one before it is left out."""
    own = F.filter(parts, lambda x, i: (i == 0) | (x != F.get(parts, i - 1)))
    return F.array_join(own, ".")


def drawing_location(number: Column, sheet: Column | None = None) -> Column:
    """struct(plant, area, unit) of a hyphenated drawing number; the unit is the sheet's number, or else the number's last part."""
    p = F.split(F.coalesce(number, F.lit("")), "-")
    area = F.when(F.size(p) >= 4, F.array_join(F.slice(p, 3, 2), "-")).otherwise(F.get(p, F.lit(0)))
    unit = F.coalesce(F.nullif(sheet, F.lit("")) if sheet is not None else F.lit(None).cast("string"), F.element_at(p, -1))
    return F.struct(F.coalesce(F.get(p, F.lit(1)), F.lit("PLANT")).alias("plant"), area.alias("area"), unit.alias("unit"))


def names_other_drawing(text: Column) -> Column:
    """Whether a tag is one of other drawings of the plant, which only refer to it here."""
    return F.coalesce(F.trim(text).rlike("|".join(rules.OTHER_DRAWING_TAGS)), F.lit(False))


def overlap_concat(a: Column, b: Column, least: int = 4) -> Column:
    """a and b joined over their longest common suffix and prefix of at least `least`, or the longer if it contains the other; else null."""
    most = F.least(F.length(a), F.length(b))
    n = F.get(F.filter(F.sequence(most, F.lit(1), F.lit(-1)), lambda s: (s >= least) & (F.right(a, s) == F.left(b, s))), F.lit(0))
    return F.when(a.contains(b), a).when(b.contains(a), b).when((most >= least) & n.isNotNull(), F.concat(a, F.substr(b, n + 1)))


def prefix_agreement(a: Column, b: Column) -> Column:
    """Characters equal place by place over the longer length."""
    same = F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    return same / F.greatest(F.length(a), F.length(b), F.lit(1))


def word_overlap(a: Column, b: Column) -> Column:
    """Shared distinct words over the larger set."""
    x, y = F.array_distinct(F.split(F.upper(F.trim(a)), r"\s+")), F.array_distinct(F.split(F.upper(F.trim(b)), r"\s+"))
    return F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y))


def is_digit_fragment(short: Column, long: Column) -> Column:
    """long is short with nothing but digits after it."""
    return long.startswith(short) & F.substr(long, F.length(short) + 1).rlike("^[0-9]+$")


def tag_similarity(a: Column, b: Column) -> Column:
    x, y = dedup_key(a), dedup_key(b)
    places = F.zip_with(F.split(x, ""), F.split(y, ""), lambda p, q: F.coalesce(p == q, F.lit(False)))
    prefix = F.coalesce(F.array_position(places, False) - 1, F.size(places))
    prefix = F.when(F.array_position(places, False) == 0, F.size(places)).otherwise(F.array_position(places, False) - 1)
    short = F.least(F.length(x), F.length(y))
    same = F.size(F.filter(places, lambda p: p))
    return F.when((x == "") | (y == ""), 0.0).when(x == y, 1.0).when(fold_confusable(x) == fold_confusable(y), 0.9).when(prefix >= 4, 0.7 * prefix / short).otherwise(2 * same / (F.length(x) + F.length(y)))


def note_order(note_id: Column) -> Column:
    return F.struct(F.coalesce(F.regexp_extract(note_id, "^([0-9]+)", 1).try_cast("int"), F.lit(999)).alias("n"), note_id.alias("id"))


# Fixed value: what a drawing's number looks like.
DRAWING_NUMBER = r"\b(\d{3,4}-[A-Z]{2,5}-\d+-\d+(?:-\d+)?)\b"


def cross_drawing_tokens(text: Column, own: Column) -> Column:
    """The numbers of other drawings in a text, in order and as often as they occur: those that begin with the own number's first part; none without an own number."""
    found = F.regexp_extract_all(text, F.lit(DRAWING_NUMBER), F.lit(1))
    return F.when(F.coalesce(own, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.filter(found, lambda t: F.startswith(t, F.substring_index(own, "-", 1)) & (t != own)))


def numbered(prefix: str, n: Column, digits: int) -> Column:
    """prefix and n with leading zeros to at least `digits` digits (lpad alone would cut longer ones)."""
    text = n.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(text) >= digits, text).otherwise(F.lpad(text, digits, "0")))


def truthy(*columns: Column) -> Column:
    """The first that is neither null, empty nor zero."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in columns])


def _ratios(a, b):
    import difflib

    import pandas as pd

    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def fuzzy_ratio(a: Column, b: Column) -> Column:
    """Ratcliff and Obershelp's ratio, which no built-in gives."""
    return F.pandas_udf(_ratios, "double", F.PandasUDFType.SCALAR)(a, b)


def parse_lenient(text: str | None) -> str | None:
    """JSON text repaired: fences, surrounding prose, single quotes, trailing commas; None if nothing helps."""
    if text is None:
        return None
    bare = re.sub(r"^\s*```[a-zA-Z]*\s*|\s*```\s*$", "", text.strip())
    span = re.search(r"[\[{].*[\]}]", bare, re.S)
    tries = [bare, *([span[0]] if span else [])]
    tries += [re.sub(r",\s*([\]}])", r"\1", t) for t in tries] + [re.sub(r",\s*([\]}])", r"\1", t.replace("'", '"')) for t in tries]
    for t in tries:
        try:
            return json.dumps(json.loads(t), ensure_ascii=False)
        except ValueError:
            continue
    return None


def _repaired(text):
    import pandas as pd

    return pd.Series([parse_lenient(t) for t in text], dtype="object")


def lenient_json(text: Column) -> Column:
    """Valid JSON stays as it is, read natively; the rest goes through the repairs."""
    plain = F.regexp_replace(F.trim(text), r"^```[a-zA-Z]*\s*|\s*```$", "")
    return F.when(F.try_parse_json(plain).isNotNull(), plain).otherwise(F.pandas_udf(_repaired, "string", F.PandasUDFType.SCALAR)(text))


# Measured variable by first letter, functions by one, two or three further letters, valves by their letters.
VARIABLES = {
    "A": "ANALYSIS", "B": "BURNER", "C": "CONDUCTIVITY", "D": "DENSITY", "E": "VOLTAGE", "F": "FLOW", "G": "GAUGING", "H": "HAND",
    "I": "CURRENT", "K": "TIME", "L": "LEVEL", "M": "MOISTURE", "P": "PRESSURE", "Q": "QUANTITY", "S": "SPEED", "T": "TEMPERATURE",
    "U": "MULTIVARIABLE", "V": "VIBRATION", "W": "WEIGHT", "X": "UNCLASSIFIED", "Y": "EVENT/STATE", "Z": "POSITION",
}
FUNCTIONS = {
    "I": "INDICATING", "T": "TRANSMITTER", "E": "ELEMENT", "V": "VALVE", "W": "WELL/THERMOWELL", "Y": "RELAY/CONVERTER", "A": "ALARM",
    "H": "HIGH", "L": "LOW", "S": "SWITCH", "C": "CONTROLLER", "D": "DIFFERENTIAL", "R": "RECORDER", "X": "UNCLASSIFIED",
    "G": "GAUGE/GLASS", "K": "CONTROL STATION",
}
COMBINED = {
    "IT": "INDICATING TRANSMITTER", "AH": "ALARM HIGH", "AL": "ALARM LOW", "HH": "ALARM HIGH HIGH", "LL": "ALARM LOW LOW",
    "SC": "SWITCH CLOSE", "SO": "SWITCH OPEN", "ZT": "POSITION TRANSMITTER", "ZY": "SOLENOID/CONVERTER", "IC": "INDICATING CONTROLLER",
    "CV": "CONTROL VALVE", "AHH": "ALARM HIGH HIGH", "ALL": "ALARM LOW LOW",
}
VALVES = {
    "BV": "BALL VALVE", "GV": "GATE VALVE", "RV": "RELIEF VALVE", "NRV": "NON-RETURN VALVE", "GLV": "GLOBE VALVE",
    "FCV": "FLOW CONTROL VALVE", "PCV": "PRESSURE CONTROL VALVE", "TCV": "TEMPERATURE CONTROL VALVE", "LCV": "LEVEL CONTROL VALVE",
}


def _lookup(values: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key)


def decode_tag(tag: Column) -> Column:
    """struct(type, measured, function, number, description) of a tag: equipment, then valve, line, logic element and instrument, the first that fits.

    An instrument's letters after the first are read greedily, three, two or one at a time; letters without a meaning are skipped."""
    def told(kind: str, measured, function, number, description) -> Column:
        parts = (("type", F.lit(kind)), ("measured", measured), ("function", function), ("number", number), ("description", description))
        return F.struct(*[c.alias(n) for n, c in parts])

    none, given = F.lit(""), F.coalesce(tag, F.lit(""))
    tokens = "|".join(sorted(COMBINED, key=len, reverse=True)) + "|[A-Z]"

    def of(x: Column) -> Column:
        raw, clean = x["raw"], x["clean"]
        valve, instrument = "^(BV|GV|RV|NRV|GLV|FCV|PCV|TCV|LCV)-?([0-9]{3,5})([A-Z]?)$", "^([A-Z]+?)-?([0-9]{2,5}[A-Z]?)$"
        kind = _lookup(VALVES, F.regexp_extract(clean, valve, 1))
        letters = F.regexp_extract(clean, instrument, 1)
        first = F.left(letters, F.lit(1))
        measured = F.coalesce(_lookup(VARIABLES, first), first)
        found = F.transform(F.regexp_extract_all(F.substr(letters, F.lit(2)), F.lit(f"({tokens})"), F.lit(1)), lambda w: _lookup(COMBINED | FUNCTIONS, w))
        function = F.array_join(found, " ")  # letters without a meaning are null and left out
        return (
            F.when(given == "", told("UNKNOWN", none, none, none, none))
            .when(raw.rlike("^[A-Z]{1,3}-V-[0-9]{3}[A-Z]?$"), told("EQUIPMENT", none, none, F.regexp_extract(raw, "^[A-Z]{1,3}-V-([0-9]{3})", 1), raw))
            .when(clean.rlike(valve), told("VALVE", none, kind, F.concat(F.regexp_extract(clean, valve, 2), F.regexp_extract(clean, valve, 3)), kind))
            .when(clean.rlike("^[0-9]{1,2}[\"']?-"), told("PIPING", none, none, none, F.concat(F.lit("PIPING,"), clean)))
            .when(clean.rlike("^I-?[0-9]{3}[A-Z]?$"), told("LOGIC", none, F.lit("INTERLOCK"), F.regexp_extract(clean, "^I-?([0-9]{3}[A-Z]?)$", 1), F.lit("INTERLOCK/LOGIC ELEMENT")))
            .when(clean.rlike(instrument), told("INSTRUMENT", measured, function, F.regexp_extract(clean, instrument, 2), F.trim(F.concat_ws(" ", measured, function))))
            .otherwise(told("UNKNOWN", none, none, none, given))
        )

    raw = F.trim(F.upper(given))
    return let(F.struct(raw.alias("raw"), F.regexp_replace(raw, "^[A-Z0-9]+-(?=[A-Z]+-?[0-9])", "").alias("clean")), of)
