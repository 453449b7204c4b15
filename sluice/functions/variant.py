"""Strict readers for single JSON values held as VARIANT, as SQL expressions.

Spark's own casts are more lenient than the feed's rules (a JSON number would become text,
``true`` would become 1), so every reader looks at the JSON kind first, and gives NULL where
the rule gives no value. Arguments and results are SQL text: decoding uses hundreds of these,
and one text is parsed far faster than the same Column is built call by call.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

# Largest value of a 96-bit decimal; longer numbers do not parse.
_DECIMAL_LIMIT = "79228162514264337593543950335"
# Any number of so many digits before the point is below it.
DECIMAL_DIGITS = len(_DECIMAL_LIMIT) - 1
# Number text: optional sign on one side, commas anywhere before the point, no exponent.
_NUMBER = "([0-9,]*[0-9][0-9,]*([.][0-9]*)?|,*[.][0-9]+)"
_SIGNED_NUMBER = rf"^([+-]?{_NUMBER}|{_NUMBER}\s*[+-])$"


def parse_whole(text: str) -> str:
    """Parse JSON text into a VARIANT array of the value and a closing mark.

    ``try_parse_json`` stops after the first value and ignores what follows. Wrapping the
    text as ``[text,0]`` turns trailing text into a syntax error or another element count;
    :func:`whole_value` reads the value and checks the count.
    """
    return f"try_parse_json(concat('[', {text}, ',0]'))"


def as_array(parsed: str, element_type: str) -> str:
    return f"try_variant_get({parsed}, '$', 'array<{element_type}>')"


def whole_value(elements: str) -> str:
    """First element of :func:`as_array`; NULL if the text was not one whole value."""
    return f"IF(size({elements}) = 2, get({elements}, 0), NULL)"


def fields(value: str, names: Sequence[str], texts: Collection[str] = ()) -> str:
    """An object's members as a struct of VARIANTs; NULL if the value is no object.

    Members among ``texts`` are read as the bytes of their text at once, NULL if they are none (see :func:`text`).

    Taking a nested *object* out as VARIANT copies it, so read the innermost members in one
    cast to a nested struct type where possible.
    """
    members = ", ".join(f"`{n}`: {'binary' if n in texts else 'variant'}" for n in names)
    return f"try_variant_get({value}, '$', 'struct<{members}>')"


def is_absent(value: str) -> str:
    """Missing member or JSON null."""
    return f"({value} IS NULL OR is_variant_null({value}))"


def is_bad_text(value: str, text: str | None = None) -> str:
    """A member that must be a string, null or missing, but is something else.

    ``text`` is what :func:`text` gives for it, if that was read already.
    """
    if text is not None:
        return f"({text} IS NULL AND NOT {is_absent(value)})"
    return f"(schema_of_variant({value}) NOT IN ('STRING', 'VOID'))"


def text(value: str) -> str:
    """A JSON string's text; anything else is NULL.

    Of the kinds JSON has, only a string casts to binary. So the value is looked at once, and the
    schema of a whole object is not spelled out to see that it is none.
    """
    return f"CAST(try_variant_get({value}, '$', 'binary') AS STRING)"


def integer(value: str, kind: str = "int") -> str:
    """A whole JSON number within 32 bits (64 as bigint), or a string that reads as one."""
    return (
        f"IF(schema_of_variant({value}) IN ('BIGINT', 'STRING'),"
        f" try_cast(try_variant_get({value}, '$', 'string') AS {kind}), NULL)"
    )


def json_kind(value: str) -> str:
    """null (or missing), string, boolean, object, array or number."""
    kind = f"schema_of_variant({value})"
    return (
        f"CASE WHEN {is_absent(value)} THEN 'null' WHEN {kind} = 'STRING' THEN 'string'"
        f" WHEN {kind} = 'BOOLEAN' THEN 'boolean' WHEN {kind} LIKE 'OBJECT%' THEN 'object'"
        f" WHEN {kind} LIKE 'ARRAY%' THEN 'array' ELSE 'number' END"
    )


def number_text(value: str) -> str:
    """Text of a JSON number or string, as (text, kind)."""
    return f"struct(try_variant_get({value}, '$', 'string') AS text, schema_of_variant({value}) AS kind)"


def wide_decimal(number: str, scale: int) -> str:
    """A JSON number, or text in number format, rounded half up to ``scale`` digits.

    Takes :func:`number_text`; a boolean is no number. The result has room for more digits than any
    target column: whether it fits the column is a constraint of the table, which the caller checks.
    """
    trimmed = rf"regexp_replace({number}.text, r'^\s+|\s+$', '')"
    digits = rf"regexp_replace({number}.text, r'[,+\s-]', '')"
    sign = f"IF(contains({number}.text, '-'), '-', '')"
    return (
        f"try_cast(CASE WHEN {number}.kind = 'BOOLEAN' THEN NULL WHEN {number}.kind <> 'STRING' THEN {number}.text"
        f" WHEN {trimmed} RLIKE r'{_SIGNED_NUMBER}' THEN concat({sign}, {digits}) END"
        f" AS DECIMAL(38, {scale}))"
    )


def parsed_decimal(wide: str) -> str:
    """NULL for numbers beyond the 96 bits a decimal is parsed into."""
    return f"IF(abs({wide}) <= CAST('{_DECIMAL_LIMIT}' AS DECIMAL(38, 0)), {wide}, NULL)"


def day(raw: str) -> str:
    """A date out of ISO date or date-time text, or one of the common other forms.

    Those are ``M/d/yyyy`` and ``yyyy/M/d``, ``d MMM yyyy`` and ``MMM d, yyyy`` with short or
    full month names, each with or without a time of day, and the form of mail headers.
    Takes trimmed text. Date-times with a zone are read as their UTC day, whatever the
    session's zone is; mail headers are in GMT.
    """
    iso = r"^\d{4}-\d{1,2}-\d{1,2}[Tt ]"
    time = r"( \d{1,2}:\d{2}(:\d{2})?( [AaPp][Mm])?)?$"
    month, full = "[A-Za-z]{3}", "[A-Za-z]{3,9}"
    forms = [
        (r"\d{1,2}/\d{1,2}/\d{4}", "M/d/yyyy"), (r"\d{4}/\d{1,2}/\d{1,2}", "yyyy/M/d"),
        (rf"\d{{1,2}} {month} \d{{4}}", "d MMM yyyy"), (rf"\d{{1,2}} {full} \d{{4}}", "d MMMM yyyy"),
        (rf"{month} \d{{1,2}}, \d{{4}}", "MMM d, yyyy"), (rf"{full} \d{{1,2}}, \d{{4}}", "MMMM d, yyyy"),
    ]
    others = "".join(
        rf" WHEN {raw} RLIKE r'^{shape}{time}' THEN try_to_date(regexp_extract({raw}, r'^{shape}', 0), '{form}')"
        for shape, form in forms
    )
    mail = rf"^{month}, (\d{{1,2}} {month} \d{{4}}) \d{{2}}:\d{{2}}:\d{{2}} GMT$"
    return (
        rf"CASE WHEN {raw} RLIKE r'^\d{{4}}-\d{{1,2}}(-\d{{1,2}})?$' THEN try_cast({raw} AS DATE)"
        rf" WHEN {raw} RLIKE r'{iso}.*([Zz]|[+-]\d\d(:?\d\d)?)$'"
        rf" THEN CAST(to_utc_timestamp(try_cast({raw} AS TIMESTAMP), current_timezone()) AS DATE)"
        rf" WHEN {raw} RLIKE r'{iso}' THEN CAST(try_cast({raw} AS TIMESTAMP_NTZ) AS DATE)"
        rf"{others} WHEN {raw} RLIKE r'{mail}' THEN try_to_date(regexp_extract({raw}, r'{mail}', 1), 'd MMM yyyy')"
        " END"
    )
