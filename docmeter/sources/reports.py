"""Reports of three validators as one table of findings, and what couldn't be read as another.

Reports come as rows (file, kind, text); ``kind`` is ``verapdf`` (XML), ``ace`` or ``adobe`` (JSON). Parsing is
bound to schemas: fields of another shape are null, and a report that is no XML or JSON at all is a reject with its file and reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules that fail because of fonts that came with the source, and phrases of descriptions that say so. Fixed values.
FONT_RULES = [
    "ISO 14289-1:2014-7.21.4.1-1", "ISO 14289-1:2014-7.21.4.2-2", "ISO 14289-1:2014-7.21.7-1", "ISO 14289-1:2014-7.21.7-2", "ISO 14289-1:2014-7.21.8-1",
]
FONT_PHRASES = [
    "cidset",
    "embedded font program glyph data is incomplete",
    "tounicode cmap contains invalid zero-value unicode mappings",
    "embedded font program",
    "font programs for all fonts used for rendering within a conforming file shall be embedded within that file",
    "shall define the map of all used character codes to unicode values",
    ".notdef glyph",
]
_RULE = "_status string, _specification string, _clause string, _testNumber string, _description string, _location string, status string, ruleId string, description string, location string"
_ASSERTION = (
    "struct<`earl:result`: struct<`earl:outcome`: string, `dct:description`: string, `earl:pointer`: struct<cfi: string>>, "
    "`earl:test`: struct<`dct:title`: string, `dct:identifier`: string, `earl:impact`: string, `dct:description`: string, help: string>>"
)
_CHECK = "struct<Rule: string, check: string, Status: string, Description: string, Details: string, category: string>"
COLUMNS = ["file", "tool", "category", "id", "status", "impact", "description", "help", "location", "font_limited"]


def font_limited(rule: Column, description: Column) -> Column:
    """Whether a rule fails for a font of the source, which structure can't mend."""
    said = F.lower(F.coalesce(description, F.lit("")))
    return rule.isin(*FONT_RULES) | F.exists(F.array(*map(F.lit, FONT_PHRASES)), lambda x: F.contains(said, x))


def _given(*columns: Column | str) -> Column:
    """The first that isn't empty."""
    return F.coalesce(*[F.nullif(F.trim(F.col(c) if isinstance(c, str) else c), F.lit("")) for c in columns], F.lit(""))


def _listed(c: Column) -> Column:
    """JSON texts of a list's objects; a lone object is a list of one."""
    items = F.from_json(F.when(F.ltrim(c).startswith("{"), F.concat(F.lit("["), c, F.lit("]"))).otherwise(c), "array<string>")
    return F.filter(items, lambda x: F.ltrim(x).startswith("{"))


def _by_kind(**columns: Column) -> Column:
    """The column for a row's kind, the others aren't worked out."""
    out = F.lit(None)
    for kind, c in columns.items():
        out = F.when(F.col("kind") == kind, c).otherwise(out)
    return out


def _parts(rows: DataFrame) -> DataFrame:
    """file, kind, place, flat, body: the rules of an XML report, the assertions of an EPUB report, the entries of both forms of a report of checks."""
    plain = F.regexp_replace("text", r"<(/?)[A-Za-z_][\w.-]*:", "<$1")
    rules = F.regexp_extract_all(plain, F.lit(r"(?s)<rule(?:\s[^>]*)?/>|<rule(?:\s[^>]*)?>.*?</rule>"), F.lit(0))
    top = F.col("top")
    detailed = F.from_json(F.coalesce(top["Detailed Report"], top["detailed report"]), "map<string,string>")
    part = lambda body, place="", flat=False: F.struct(F.lit(place).alias("place") if isinstance(place, str) else place.alias("place"), F.lit(flat).alias("flat"), body.alias("body"))
    entries = lambda m, flat: F.coalesce(F.transform(F.map_entries(m), lambda e: part(e["value"], e["key"], flat)), F.array().cast("array<struct<place: string, flat: boolean, body: string>>"))
    rows = rows.select("file", "kind", "text", F.from_json(F.when(F.col("kind") != "verapdf", F.col("text")), "map<string,string>").alias("top"))
    parts = _by_kind(verapdf=F.transform(rules, lambda x: part(x)), ace=F.transform(_listed(top["assertions"]), lambda x: part(x)), adobe=F.concat(entries(detailed, False), entries(top, True)))
    return rows.select("file", "kind", F.explode(parts).alias("p")).select("file", "kind", "p.*")


def _pieces(parts: DataFrame) -> DataFrame:
    """file, kind, place, name, piece: one rule, assertion or check a row."""
    body, outer = F.col("body"), F.col("outer")
    piece = lambda x, name=None: F.struct((F.lit(None).cast("string") if name is None else name).alias("name"), x.alias("piece"))
    rows = parts.withColumn("outer", F.from_json(F.when(F.col("kind") == "ace", body), "`earl:testSubject` struct<url: string>, assertions string"))
    named = F.filter(F.transform(F.map_entries(F.from_json(body, "map<string,string>")), lambda e: piece(e["value"], e["key"])), lambda x: F.ltrim(x["piece"]).startswith("{"))
    listed = lambda c: F.transform(_listed(c), lambda x: piece(x))
    checks = F.when(F.ltrim(body).startswith("["), listed(body)).when(F.col("flat") & F.ltrim(body).startswith("{"), named)
    pieces = _by_kind(verapdf=F.array(piece(body)), ace=listed(outer["assertions"]), adobe=checks)
    place = _by_kind(ace=outer["earl:testSubject"]["url"], adobe=F.col("place"))
    return rows.select("file", "kind", place.alias("place"), F.explode(pieces).alias("x")).select("file", "kind", "place", "x.*")


def _read(reports: DataFrame) -> DataFrame:
    """Findings of reports of any kinds in one pass over them: what the three readers below say of each kind."""
    of = lambda kind: F.when(F.col("kind") == kind, F.col("piece"))
    read = F.struct(F.from_xml(of("verapdf"), _RULE, {"rowTag": "rule"}).alias("r"), F.from_json(of("ace"), _ASSERTION).alias("s"), F.from_json(of("adobe"), "map<string,string>").alias("c"))
    # exploded, so that the conditions below don't parse a piece again for each field they ask for
    rows = _pieces(_parts(reports)).select("file", "kind", "place", "name", F.explode(F.array(read)).alias("read")).select("file", "kind", "place", "name", "read.*")
    r, c, name = F.col("r"), F.col("c"), F.col("name")
    result, test = F.col("s.`earl:result`"), F.col("s.`earl:test`")
    failed = F.lower(F.when(r["status"].isNotNull(), F.trim(r["status"])).otherwise(F.coalesce(r["_status"], F.lit("")))) == "failed"
    asserted = F.lower(F.coalesce(result["earl:outcome"], F.lit(""))).endswith("failed")
    checked = name.isNull() | F.map_contains_key(c, F.lit("status")) | F.map_contains_key(c, F.lit("Status"))
    rows = rows.where(_by_kind(verapdf=failed, ace=asserted, adobe=checked))

    spec = F.concat_ws("-", *[F.coalesce(r[x], F.lit("")) for x in ("_specification", "_clause", "_testNumber")])
    named = F.when(F.coalesce(r["_clause"], F.lit("")) != "", F.regexp_replace(spec, "^-+|-+$", ""))
    cfi = result["earl:pointer"]["cfi"]
    first = F.when(F.ltrim(cfi).startswith("["), F.coalesce(F.get(F.from_json(cfi, "array<string>"), F.lit(0)), F.lit(""))).otherwise(F.coalesce(cfi, F.lit("")))
    helped = F.when(F.ltrim(test["help"]).startswith("{"), F.from_json(test["help"], "map<string,string>")["dct:title"])
    either = lambda *keys: F.coalesce(*[c[k] for k in keys], F.lit(""))
    own = _by_kind(verapdf=_given(r["ruleId"], F.coalesce(named, F.lit(""))), ace=_given(test["dct:title"], test["dct:identifier"]), adobe=F.coalesce(name, either("Rule", "check")))
    said = _by_kind(verapdf=_given(r["description"], r["_description"]), ace=_given(test["dct:description"], result["dct:description"]), adobe=either("Description", "description"))
    rows = rows.withColumns({"own": own, "said": said})
    own, said = F.col("own"), F.col("said")
    shaped = {
        "tool": F.col("kind"),
        "category": _by_kind(adobe=F.coalesce(F.when(name.isNull(), c["category"]), F.col("place")), ace=F.lit(""), verapdf=F.lit("")),
        "id": _by_kind(verapdf=F.when(own == "", "unknown-rule").otherwise(own), ace=F.when(own == "", "ace-unknown-rule").otherwise(own), adobe=own),
        "status": _by_kind(verapdf=F.lit("Failed"), ace=F.lit("Failed"), adobe=F.trim(either("status", "Status"))),
        "impact": _by_kind(verapdf=F.lit("serious"), ace=F.coalesce(F.nullif(test["earl:impact"], F.lit("")), F.lit("moderate")), adobe=F.lit("")),
        "description": _by_kind(verapdf=F.when(said == "", F.format_string("PDF/UA-1 rule %s failed", own)).otherwise(said), ace=said, adobe=said),
        "help": _by_kind(verapdf=F.format_string("PDF/UA-1 compliance failure: %s", own), ace=F.coalesce(helped, F.lit("")), adobe=F.lit("")),
        "location": _by_kind(verapdf=_given(r["location"], r["_location"]), ace=F.trim(F.concat_ws(" ", F.coalesce("place", F.lit("")), F.nullif(first, F.lit("")))), adobe=either("Details", "details")),
        "font_limited": (F.col("kind") == "verapdf") & font_limited(own, said),
    }
    return rows.select("file", *[shaped[x].alias(x) for x in COLUMNS[1:]])


def _of_kind(reports: DataFrame, kind: str) -> DataFrame:
    return _read(reports.select("file", F.lit(kind).alias("kind"), "text"))


def verapdf_findings(reports: DataFrame) -> DataFrame:
    """Failed rules of XML reports, wherever they stand and whatever their namespace's prefix. A rule without an id is named by specification, clause and test."""
    return _of_kind(reports, "verapdf")


def ace_findings(reports: DataFrame) -> DataFrame:
    """Failed assertions of EPUB reports, those of each content document."""
    return _of_kind(reports, "ace")


def adobe_findings(reports: DataFrame) -> DataFrame:
    """All checks, passed ones too, of reports in the detailed and the older flat form."""
    return _of_kind(reports, "adobe")


READERS = {"verapdf": verapdf_findings, "ace": ace_findings, "adobe": adobe_findings}


def _problem() -> Column:
    text = F.col("text")
    xml = F.from_xml(text, "_corrupt_record string, nothing string", {"columnNameOfCorruptRecord": "_corrupt_record"})["_corrupt_record"].isNotNull() | (F.trim(text) == "")
    json = F.from_json(text, "map<string,string>").isNull()
    return F.when(F.coalesce(F.col("kind").isin(*READERS), F.lit(False)) == F.lit(False), "unknown kind").when(text.isNull(), "no text").when(F.col("kind") == "verapdf", F.when(xml, "no XML")).when(json, "no JSON object")


def findings(reports: DataFrame) -> DataFrame:
    """All findings of readable reports: file, tool, category, id, status, impact, description, help, location, font_limited."""
    return _read(reports.where(_problem().isNull()))


def rejects(reports: DataFrame) -> DataFrame:
    """file, kind, reason of reports that can't be read."""
    return reports.select("file", "kind", _problem().alias("reason")).where("reason is not null")
