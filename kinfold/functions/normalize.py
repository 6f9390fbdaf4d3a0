"""Normalizers of organisation records as column expressions, and column roles."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# Legal forms before and after a name, regular expressions in order of preference.
# Forms with letters outside ASCII are left out, as names are folded to ASCII before they are matched.
LEGAL_PREFIXES = ["pt", "cv", "ud", "sdn", "gmbh & co"]
LEGAL_SUFFIXES = [
    r"inc(?:orporated)?", r"corp(?:oration)?", r"l\.?l\.?c\.?", r"l\.?l\.?p\.?", r"ltd\.?", r"limited", r"plc", r"co(?:\.|mpany)?\s*ltd\.?", r"gmbh\b", r"bv", r"ab", r"oy",
    r"s\.?a\.?r\.?l\.?", r"s\.?a\.?\b", r"cvba", r"bvba", r"sab", r"sa\b", r"societe\s+anonyme", r"ag\b", r"aktiengesellschaft", r"gesellschaft\s+mit\s+beschrankter\s+haftung",
    r"spa\b", r"societa\s+per\s+azioni", r"srl\b", r"s\.?r\.?l\.?", r"societa\s+a\s+responsabilita\s+limitata", r"s\.?a\.?\b", r"sociedad\s+anonima", r"s\.?l\.?\b", r"sociedad\s+limitada",
    r"srl\b", r"sociedad\s+de\s+responsabilidad\s+limitada", r"nv\b", r"naamloze\s+vennootschap", r"cv\b", r"commanditaire\s+vennootschap", r"sp\.?\s*z\s*o\.?\s*o\.?\b",
    r"spolka\s+z\s+ograniczona\s+odpowiedzialnoscia", r"sa\b", r"spolka\s+akcyjna", r"spol\s*s\s*r\.?o\.?\b", r"spolecnost\s+s\r?o\.?", r"s\.?r\.?o\.?\b", r"ltda\b", r"limitada",
    r"pty\.?\s*ltd\.?", r"bhd\.?", r"sdn\.?\s*bhd\.?", r"sendirian\s+berhad", r"pte\.?\s*ltd\.?", r"pte", r"tbk", r"persero", r"perseroan\s+terbatas", r"pt\.?\s*(?:persero)?\s*terbatas",
    r"perusahaan\s+terbatas", r"l\.?p\.?", r"company\s+limited", r"youxian\s+gongsi", r"gongsi\s+youxian", r"kabushiki\s+kaisha", r"kabushiki\s+gaisha", r"kk", r"gk", r"godo\s+kaisha",
    r"yuhan\s+hoesa", r"yh", r"pvt\.?\s*ltd\.?", r"private\s+limited", r"llp", r"esignation\s+llp", r"limited\s+liability\s+partnership", r"joint\s+stock\s+company", r"jsc", r"tnhh",
    r"public\s+company\s+limited", r"pcl", r"corporation", r"inc\.", r"dba\b", r"d/b/a\b", r"doing\s+business\s+as", r"lllp\b", r"lp\b", r"pc\b", r"professional\s+corporation", r"lte\b",
    r"limited\s+by\s+shares", r"eireli\b", r"empresa\s+individual\s+de\s+responsabilidade\s+limitada", r"pty\b", r"proprietary\s+limited", r"npc\b", r"non-profit\s+company", r"association",
    r"foundation", r"trust", r"ngo\b", r"zao", r"ao", r"kft\.", r"rt\.", r"zrt\.", r"nyrt\.", r"s\.r\.l\.", r"s\.a\.", r"tov", r"pat", r"prat", r"pjsc",
    r"public\s+joint\s+stock\s+company", r"spc", r"single\s+person\s+company", r"aps", r"a/s", r"as", r"oyj", r"d\.o\.o\.", r"a\.d\.", r"eurl", r"snc", r"spa", r"sociedad\s+por\s+acciones",
]
# Names of columns by role.
COMPANY_NAMES = ["company", "company_name", "organization", "org", "business", "firm", "name"]
DOMAIN_NAMES = ["domain", "website", "url", "web", "site", "email"]
PHONE_PARTS = ["phone", "telephone", "tel", "mobile", "cell"]
ADDRESS_PARTS = ["address", "street", "city", "state", "zip", "postal", "location"]
ID_NAMES = ["id", "record_id", "sys id", "system id", "identifier", "key", "sys_id", "system_id"]
ID_PARTS = ["id", "key", "identifier"]
DOMAIN_SHAPE = r"^[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\z"
#: White space and separators of any script, as far as they surround values.
SPACE = r"[\t-\r\x1c-\x1f\x85\p{Z}]"


def prefix_pattern() -> str:
    return rf"^(?:{'|'.join(LEGAL_PREFIXES)})\b[\s\.,]*"


def suffix_pattern(anchored: bool = False) -> str:
    """Legal forms as whole words; ``anchored`` matches them at the end of a name only."""
    return rf"\b(?:{'|'.join(LEGAL_SUFFIXES)})\b\.?" + ("$" if anchored else "")


def company(name: Column, anchored: bool = False) -> Column:
    """Normalized form of a name that is ASCII already; null gives the empty string."""
    spaced = lambda c: F.btrim(F.regexp_replace(c, r"\s+", " "))
    c = spaced(F.lower(F.coalesce(name, F.lit(""))))
    c = F.regexp_replace(c, r"^the\s+", "")
    c = F.btrim(F.regexp_replace(c, prefix_pattern(), ""))
    c = F.replace(c, F.lit("&"), F.lit(" and "))
    c = spaced(F.regexp_replace(c, r"[^\w\s&/.-]+", " "))
    for _ in range(2):
        c = spaced(F.regexp_replace(c, suffix_pattern(anchored), ""))
    return F.btrim(F.regexp_replace(c, r"[./-]+$", ""))


def domain(value: Column) -> Column:
    """Host of a web or mail address, the empty string if there is none."""
    c = F.regexp_replace(F.lower(value), rf"^{SPACE}+|{SPACE}+\z", "")
    c = F.substring_index(c, "@", -1)
    c = F.regexp_replace(F.regexp_replace(c, r"^https?://(?:www\.)?", ""), r"^www\.", "")
    c = F.substring_index(c, "/", 1)
    return F.when(c.rlike(DOMAIN_SHAPE), c).otherwise(F.lit(""))


def phone(value: Column) -> Column:
    """North American numbers in one notation, the empty string for others."""
    d = F.regexp_replace(value, "[^0-9]", "")
    shown = lambda at: F.concat(F.lit("("), F.substring(d, at, 3), F.lit(") "), F.substring(d, at + 3, 3), F.lit("-"), F.substring(d, at + 6, 4))
    return F.when(F.length(d) == 10, shown(1)).when((F.length(d) == 11) & d.startswith("1"), F.concat(F.lit("1-"), shown(2))).otherwise(F.lit(""))


def address(parts: list[Column]) -> Column:
    """The parts that aren't blank, in order, one space between words; case is kept."""
    given = [F.when(F.btrim(F.regexp_replace(p, r"\s+", " ")) != "", p) for p in parts]
    return F.btrim(F.regexp_replace(F.concat_ws(" ", *given), r"\s+", " "))


@pandas_udf(StringType())
def _folded(names: pd.Series) -> pd.Series:
    def fold(name: str) -> str:
        plain = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode("ascii")
        return "sony" if not plain.strip() and "ソニー" in name else plain

    return names.map(fold, na_action="ignore")


def fold_to_ascii(df: DataFrame, column: str) -> DataFrame:
    """Replace a column by its compatibility decomposition without what isn't ASCII.

    Only rows that hold other characters pass through Python; a function in a
    branch of when() would be run for every row.
    """
    other = F.coalesce(F.col(column).rlike(r"[^\x00-\x7F]"), F.lit(False))
    return df.filter(~other).unionByName(df.filter(other).withColumn(column, _folded(F.col(column))))


def roles(columns: list[str]) -> dict:
    """The columns that hold company, domain, phone, id (or None) and the address parts.

    Names are compared in lower case; the first column in order wins.
    """
    low = [(c, c.lower()) for c in columns]
    exact = lambda names: next((c for c, x in low if x in names), None)
    part = lambda parts: next((c for c, x in low if any(p in x for p in parts)), None)
    return {
        "company": exact(COMPANY_NAMES) or part(COMPANY_NAMES),
        "domain": exact(DOMAIN_NAMES),
        "phone": part(PHONE_PARTS),
        "address": [c for c, x in low if any(p in x for p in ADDRESS_PARTS)],
        "id": exact(ID_NAMES) or part(ID_PARTS),
    }
