"""Text expressions: project tags, editor labels, COPY-text unescaping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# A project tag in a changeset comment: "#hotosm", then at least one character
# that is none of  space / # , + ; . :  then "-" and digits.
PROJECT_TAG = r"#hotosm[^ /#,+;.:]+-[0-9]+"
# Editors recognised by name, case-sensitive, leftmost match; anything else is "Other".
DEFAULT_EDITORS = ("iD", "JOSM", "Potlatch")
OTHER_EDITOR = "Other"
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def last_project_tag(text) -> Column:
    """The last project tag in ``text`` (a greedy prefix skips earlier ones), NULL if none.

    ``(?s)`` lets ``.`` cross newlines as PostgreSQL's ``.`` does.
    """
    hit = F.regexp_extract(_c(text), f"(?s).*({PROJECT_TAG}).*", 1)
    return F.nullif(hit, F.lit(""))


def has_project_tag(text) -> Column:
    """``text ~ tag``; NULL text gives NULL, which a filter drops."""
    return _c(text).rlike(PROJECT_TAG)


def all_project_tags(text) -> Column:
    """Every project tag in ``text`` in order of appearance."""
    return F.regexp_extract_all(_c(text), F.lit(PROJECT_TAG), 0)


def tag_project_id(tag) -> Column:
    """The project number at the end of a tag, as int; NULL for a number no project can have."""
    return F.regexp_extract(_c(tag), r"-([0-9]+)$", 1).try_cast("int")


def editor_label(value, editors=DEFAULT_EDITORS) -> Column:
    """The first listed editor name found in ``value``, else 'Other'."""
    pattern = "(" + "|".join(editors) + ")"
    hit = F.nullif(F.regexp_extract(_c(value), pattern, 1), F.lit(""))
    return F.coalesce(hit, F.lit(OTHER_EDITOR))


# Letters after a backslash in COPY text and the bytes they stand for.
COPY_ESCAPES = {"b": 0x08, "f": 0x0C, "n": 0x0A, "r": 0x0D, "t": 0x09, "v": 0x0B}


def unescape_copy_text(col) -> Column:
    """Undo PostgreSQL COPY text escaping, in one pass over the text.

    The text is cut into plain runs and escapes: ``\\x`` with one or two hex
    digits and a backslash with one to three octal digits are bytes (of UTF-8,
    so several of them may make up a character), a backslash with one of
    ``b f n r t v`` is that control character, and with any other character,
    a line feed or a tab included, the character itself.
    """
    c = _c(col)
    tokens = F.regexp_extract_all(c, F.lit(r"(?s)[^\\]+|\\x[0-9A-Fa-f]{1,2}|\\[0-7]{1,3}|\\.|\\$"), 0)

    def hex_of(t: Column) -> Column:
        rest = F.substring(t, 2, 1_000_000_000)
        number = F.when(rest.rlike("^x[0-9A-Fa-f]"), F.upper(F.substring(t, 3, 2))).when(
            rest.rlike("^[0-7]"), F.conv(rest, 8, 16)
        )
        out = F.when(~t.startswith("\\"), F.hex(t)).when(number.isNotNull(), F.right(F.concat(F.lit("0"), number), F.lit(2)))
        for letter, byte in COPY_ESCAPES.items():
            out = out.when(rest == letter, F.lit(f"{byte:02X}"))
        return out.otherwise(F.hex(rest))

    decoded = F.unhex(F.array_join(F.transform(tokens, hex_of), "")).cast("string")
    return F.when(F.instr(c, "\\") > 0, decoded).otherwise(c)


def copy_fields(line) -> Column:
    """The fields of a COPY text row, still escaped: cut at tabs that no backslash precedes."""
    return F.regexp_extract_all(
        F.concat(_c(line), F.lit("\t")), F.lit(r"(?s)([^\t\\]*+(?:\\.[^\t\\]*+)*+)\t"), 1
    )
