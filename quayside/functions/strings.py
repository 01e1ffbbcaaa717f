"""String column functions.

Every function takes and returns ``Column`` objects built from
``pyspark.sql.functions`` only, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.util import col_of

# Fixed values that must equal the reference's behaviour.
# Characters removed from names, countries and free text before they become
# folder names (SCL-S1): ~ ! @ # $ % ^ * " ' ? , . | _ { } [ ] / – - : ;
# (the en dash "–" is included; & ( ) + and backslash are kept).
SPECIAL_CHARS_CLASS = r"""[~!@#$%^*"'?,.|_{}\[\]/–\-:;]"""
# Root folder of the document site, prefixed to every stored folder path.
SITE_ROOT = "Shared%20Documents"
# Prefix of the dated folder that receives every routed invoice (SCL-S17).
DATED_FOLDER_PREFIX = "TEST/INV_PLTesting/Prod"


def strip_special(c) -> Column:
    """SCL-S1: remove the fixed special-character set from text."""
    return F.regexp_replace(col_of(c), SPECIAL_CHARS_CLASS, "")


def plus_concat(*cols) -> Column:
    """SCL-S2: ``a + b`` text concatenation; any null operand gives null."""
    return F.concat(*[col_of(c) for c in cols])


def tsql_concat(*cols) -> Column:
    """SCL-S3: T-SQL ``CONCAT``; null operands count as ``''``."""
    return F.concat(*[F.coalesce(col_of(c), F.lit("")) for c in cols])


def drop_suffix_once(c, suffix: str) -> Column:
    """Remove ``suffix`` once from the end of the text, if present."""
    c = col_of(c)
    return F.when(c.endswith(suffix),
                  c.substr(F.lit(1), F.length(c) - len(suffix))).otherwise(c)


def clean_contacts(c) -> Column:
    """SCL-S4: remove every space, then drop one trailing ``;``."""
    return drop_suffix_once(F.replace(col_of(c), F.lit(" "), F.lit("")), ";")


def split_recipients(c) -> Column:
    """SCL-S5: ``a;b`` → ``[a, b]`` (empty items are kept, as ``str.split``)."""
    return F.split(col_of(c), ";", -1)


def path_token_after(path, token: str) -> Column:
    """SCL-S6: the path segment right after the *first* segment equal to
    ``token``; null when the token is absent or is the last segment."""
    parts = F.split(col_of(path), "/", -1)
    pos = F.array_position(parts, token)
    return F.when(pos > 0, F.try_element_at(parts, (pos + 1).cast("int")))


def pdf_stem(name) -> Column:
    """SCL-S7: lower-case the file name and remove *every* ``.pdf``."""
    return F.replace(F.lower(col_of(name)), F.lit(".pdf"), F.lit(""))


def drop_last_chars(name, n: int = 6) -> Column:
    """SCL-S8: drop the last ``n`` characters (``'4500012345a.xlsx'`` → ``'4500012345'``)."""
    c = col_of(name)
    return c.substr(F.lit(1), F.greatest(F.length(c) - n, F.lit(0)))


def rstrip_chars(c, chars: str = ".0") -> Column:
    """SCL-S9 (compat): strip every trailing character in ``chars``
    (``'5000.0'`` → ``'5'``, ``'100'`` → ``'1'``)."""
    return F.rtrim(col_of(c), F.lit(chars))


def strip_point_zero(c) -> Column:
    """SCL-S9/S10 (exact): remove one trailing ``.0`` only."""
    return drop_suffix_once(c, ".0")


def remove_all(c, text: str) -> Column:
    """SCL-S10 (compat): remove every occurrence of ``text`` (``'1.05'`` → ``'15'``)."""
    return F.replace(col_of(c), F.lit(text), F.lit(""))


def newline_to_space(c) -> Column:
    """SCL-S11: every ``\\n`` becomes a space."""
    return F.replace(col_of(c), F.lit("\n"), F.lit(" "))


def leading_zero_key(c) -> Column:
    """SCL-S12/SCL-C2: ``IIF(LEFT(k,2)='00', RIGHT(k,8), k)``."""
    c = col_of(c)
    return F.when(F.left(c, F.lit(2)) == "00", F.right(c, F.lit(8))).otherwise(c)


def with_site_root(path) -> Column:
    """SCL-S13: ``Shared%20Documents/`` + path (null path → root only, T-SQL CONCAT)."""
    return tsql_concat(F.lit(SITE_ROOT + "/"), path)


def without_site_root(path) -> Column:
    """SCL-S13: remove the site root prefix again (every occurrence, as ``str.replace``)."""
    return F.replace(col_of(path), F.lit(SITE_ROOT + "/"), F.lit(""))


def base_name(path) -> Column:
    """SCL-S14: the part after the last ``/``."""
    return F.element_at(F.split(col_of(path), "/", -1), -1)


def dated_folder(d) -> Column:
    """SCL-S17: ``TEST/INV_PLTesting/Prod`` + ``ddMMyyyy`` + ``/``."""
    return F.concat(F.lit(DATED_FOLDER_PREFIX), F.date_format(col_of(d), "ddMMyyyy"), F.lit("/"))


def option_text(c) -> Column:
    """SCL-S15 for ship-to options: remove ``"``, then ``--`` → ``-``."""
    no_quotes = F.replace(col_of(c), F.lit('"'), F.lit(""))
    return F.replace(no_quotes, F.lit("--"), F.lit("-"))


def remove_double_slash(c) -> Column:
    """SCL-S15 for destination options: remove ``//``."""
    return F.replace(col_of(c), F.lit("//"), F.lit(""))


def missing_text(c, word: str = "None") -> Column:
    """SCL-S18: text of a value, with the Python spelling of a missing one."""
    return F.coalesce(col_of(c).cast("string"), F.lit(word))


def blank(c) -> Column:
    """True where the text is null or only spaces (FLT-3's complement)."""
    c = col_of(c)
    return c.isNull() | (F.length(F.trim(c)) == 0)


def pack_texts(cols) -> Column:
    """The texts of ``cols`` (null kept) as one text, read back by
    ``unpack_texts``: equal texts and nulls, and only these, pack alike. One
    text a row takes less of a shuffle than a cell for each column."""
    def escaped(c):
        c = col_of(c)
        return F.coalesce(F.replace(F.replace(c, F.lit("\x02"), F.lit("\x02b")), F.lit("\x01"), F.lit("\x02a")), F.lit("\x02n"))
    return F.concat_ws("\x01", *[escaped(c) for c in cols])


def unpack_texts(packed) -> Column:
    """The array of texts that ``pack_texts`` made one text of."""
    plain = F.split(col_of(packed), "\x01", -1)
    exact = F.transform(plain, lambda x: F.when(x != "\x02n", F.replace(
        F.replace(x, F.lit("\x02a"), F.lit("\x01")), F.lit("\x02b"), F.lit("\x02"))))
    return F.when(F.contains(col_of(packed), F.lit("\x02")), exact).otherwise(plain)
