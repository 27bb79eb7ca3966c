"""Licence scan with ordered signature rules, with column functions only.

A rule is a keyword, a pattern, a label and a priority.  A text is looked at only if it
holds one of the ``GATE`` patterns, and a rule only if the text holds its keyword: one word, or part of one,
that no match can lack.  Matches are
intervals of the text; one is suppressed if an interval of stronger priority, or of
the same priority and found before it, contains it.  So "GPL version 3" inside an SPDX
line or a bare name inside a versioned one do not count twice.

Rules come from tables of families, names and versions: each family has rules for its
SPDX tag, its grant sentence, its address, its versioned name and its bare name.

Upper-case A-Z is lowered first.  Null counts as the empty text; a text without any match has
no detections, empty labels and score 0.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# label, keyword of the name (in every alternative, no blank), pattern of the name, versions, SPDX prefix, address
FAMILIES = [
    ("mit", "mit", r"mit", [], "mit", r"opensource\.org/licenses?/mit"),
    ("apache", "apache", r"apache(?:\s+software)?", ["1.0", "1.1", "2.0"], "apache", r"apache\.org/licenses"),
    ("gpl", "general", r"(?:gnu\s+)?general\s+public", ["1.0", "2.0", "3.0"], "gpl", r"gnu\.org/licenses/(?:old-licenses/)?gpl"),
    ("lgpl", "lesser", r"(?:gnu\s+)?lesser\s+general\s+public", ["2.1", "3.0"], "lgpl", r"gnu\.org/licenses/(?:old-licenses/)?lgpl"),
    ("lgpl", "library", r"(?:gnu\s+)?library\s+general\s+public", ["2.0"], "lgpl", r"gnu\.org/licenses/library"),
    ("agpl", "affero", r"(?:gnu\s+)?affero\s+general\s+public", ["1.0", "3.0"], "agpl", r"gnu\.org/licenses/agpl"),
    ("gfdl", "documentation", r"(?:gnu\s+)?free\s+documentation", ["1.1", "1.2", "1.3"], "gfdl", r"gnu\.org/licenses/fdl"),
    ("bsd", "bsd", r"(?:new|modified|revised|simplified|original)?\s*bsd", ["0", "2", "3", "4"], "bsd", r"opensource\.org/licenses?/bsd"),
    ("mpl", "mozilla", r"mozilla\s+public", ["1.0", "1.1", "2.0"], "mpl", r"mozilla\.org/(?:en-us/)?mpl|mozilla\.org/licenses"),
    ("epl", "eclipse", r"eclipse\s+public", ["1.0", "2.0"], "epl", r"eclipse\.org/legal/epl"),
    ("edl", "eclipse", r"eclipse\s+distribution", ["1.0"], "edl", r"eclipse\.org/org/documents/edl"),
    ("cpl", "common", r"(?:ibm\s+)?common\s+public", ["1.0"], "cpl", r"opensource\.org/licenses?/cpl"),
    ("cddl", "development", r"common\s+development\s+and\s+distribution", ["1.0", "1.1"], "cddl", r"opensource\.org/licenses?/cddl"),
    ("isc", "isc", r"isc", [], "isc", r"opensource\.org/licenses?/isc"),
    ("zlib", "zlib", r"zlib(?:/libpng)?", [], "zlib", r"opensource\.org/licenses?/zlib"),
    ("boost", "boost", r"boost\s+software", ["1.0"], "bsl", r"boost\.org/license"),
    ("artistic", "artistic", r"(?:perl\s+)?artistic", ["1.0", "2.0"], "artistic", r"opensource\.org/licenses?/artistic"),
    ("unlicense", "unlicense", r"(?:the\s+)?unlicense", [], "unlicense", r"unlicense\.org"),
    ("wtfpl", "fuck", r"do\s+what\s+the\s+fuck\s+you\s+want\s+to\s+public", ["2.0"], "wtfpl", r"wtfpl\.net"),
    ("cc0", "licen", r"(?:creative\s+commons\s+)?cc0|creative\s+commons\s+zero", ["1.0"], "cc0", r"creativecommons\.org/publicdomain/zero"),
    ("cc-by", "attribution", r"(?:creative\s+commons|cc)\s+attribution", ["2.0", "2.5", "3.0", "4.0"], "cc-by", r"creativecommons\.org/licenses/by/"),
    ("cc-by-sa", "sharealike", r"(?:creative\s+commons|cc)\s+attribution[\s-]+sharealike", ["2.0", "2.5", "3.0", "4.0"], "cc-by-sa", r"creativecommons\.org/licenses/by-sa"),
    ("cc-by-nc", "noncommercial", r"(?:creative\s+commons|cc)\s+attribution[\s-]+noncommercial", ["2.0", "3.0", "4.0"], "cc-by-nc", r"creativecommons\.org/licenses/by-nc/"),
    ("cc-by-nd", "noderiv", r"(?:creative\s+commons|cc)\s+attribution[\s-]+noderiv(?:s|atives)", ["2.0", "3.0", "4.0"], "cc-by-nd", r"creativecommons\.org/licenses/by-nd"),
    ("eupl", "european", r"european\s+union\s+public", ["1.0", "1.1", "1.2"], "eupl", r"joinup\.ec\.europa\.eu\S*eupl"),
    ("osl", "software", r"open\s+software", ["1.0", "2.0", "2.1", "3.0"], "osl", r"opensource\.org/licenses?/osl"),
    ("afl", "academic", r"academic\s+free", ["1.1", "1.2", "2.0", "2.1", "3.0"], "afl", r"opensource\.org/licenses?/afl"),
    ("python", "python", r"python(?:\s+software\s+foundation)?", ["2.0"], "python", r"docs\.python\.org/\S*license"),
    ("php", "php", r"php", ["3.0", "3.01"], "php", r"php\.net/license"),
    ("ruby", "ruby", r"ruby", [], "ruby", r"ruby-lang\.org/\S*license"),
    ("openssl", "openssl", r"openssl", [], "openssl", r"openssl\.org/source/license"),
    ("ofl", "font", r"(?:sil\s+)?open\s+font", ["1.0", "1.1"], "ofl", r"scripts\.sil\.org/ofl|openfontlicense\.org"),
    ("ms-pl", "microsoft", r"microsoft\s+public", [], "ms-pl", r"opensource\.org/licenses?/ms-pl"),
    ("ms-rl", "reciprocal", r"microsoft\s+reciprocal", [], "ms-rl", r"opensource\.org/licenses?/ms-rl"),
    ("ncsa", "illinois", r"(?:university\s+of\s+)?illinois(?:/ncsa)?\s+open\s+source", [], "ncsa", r"opensource\.org/licenses?/ncsa"),
    ("postgresql", "postgresql", r"postgresql", [], "postgresql", r"opensource\.org/licenses?/postgresql"),
    ("w3c", "w3c", r"w3c(?:\s+software)?", [], "w3c", r"w3\.org/consortium/legal\S*license"),
    ("x11", "x11", r"x11", [], "x11", r"xfree86\.org/\S*license"),
    ("vim", "vim", r"vim", [], "vim", r"vimdoc\.sourceforge\.net\S*license"),
    ("cecill", "cecill", r"cecill", ["1.0", "1.1", "2.0", "2.1"], "cecill", r"cecill\.info/licences"),
    ("mulan", "mulan", r"mulan\s+permissive\s+software", ["1.0", "2.0"], "mulanpsl", r"license\.coscl\.org\.cn"),
    ("bsl", "business", r"business\s+source", ["1.1"], "busl", r"mariadb\.com/bsl"),
    ("elastic", "elastic", r"elastic", ["1.0", "2.0"], "elastic", r"elastic\.co/licensing"),
    ("sspl", "server", r"server\s+side\s+public", ["1.0"], "sspl", r"mongodb\.com/licensing"),
    ("odbl", "database", r"open\s+(?:data\s+commons\s+open\s+)?database", ["1.0"], "odbl", r"opendatacommons\.org/licenses/odbl"),
    ("qpl", "public", r"q\s+public", ["1.0"], "qpl", r"opensource\.org/licenses?/qpl"),
]
# Phrases of the licences' own texts: label, keyword, pattern.
PHRASES = [
    ("mit", "hereby", r"permission\s+is\s+hereby\s+granted,\s+free\s+of\s+charge,\s+to\s+any\s+person\s+obtaining\s+a\s+copy\b.{0,400}?licen[cs]e"),
    ("bsd", "redistribution", r"redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms.{0,200}?copyright"),
    ("gpl", "redistribute", r"free\s+software[;:,]\s+you\s+can\s+redistribute\s+it\s+and/or\s+modify\s+it\s+under\s+the\s+terms\s+of\s+the\s+gnu\s+general\s+public\s+licen[cs]e"),
    ("isc", "permission", r"permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute\s+this\s+software.{0,200}?copyright"),
    ("public-domain", "domain", r"(?:released|placed|dedicated)\s+(?:in|into|to)\s+the\s+public\s+domain"),
    ("proprietary", "reserved", r"copyright\s+(?:\(c\)|©)?\s*\d{0,4}[^\n]{0,80}?all\s+rights\s+reserved"),
]
# Patterns of which every rule and every base phrase needs one; most hold "licen".
GATE = [
    "licen", "copyright", r"public\s+domain", r"mozilla\.org", r"eclipse\.org", r"wtfpl\.net", r"creativecommons\.org",
    r"joinup\.ec\.europa\.eu", r"scripts\.sil\.org", r"mariadb\.com",
]
BASE = [("mit", ["mit", "license"]), ("apache", ["apache", "license"]), ("gpl", ["general", "public", "license"])]
# ----------------------------------------------------------------------------

LICENCE = r"\s+licen[cs]e"
WEIGHTS = {1: 1.0, 2: 0.95, 3: 0.8, 4: 0.6}
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def signature_rules() -> list[dict]:
    """All rules in order: keyword, pattern, label, priority (1 is the strongest)."""
    rules = []

    def add(priority: int, label: str, keyword: str, pattern: str) -> None:
        rules.append({"priority": priority, "label": label, "keyword": keyword, "pattern": rf"(?s)(?<![a-z0-9]){pattern}(?![a-z0-9])"})

    for label, keyword, phrase in PHRASES:
        add(1, label, keyword, phrase)
    for label, keyword, name, versions, spdx, address in FAMILIES:
        tag = rf"spdx-license-identifier:\s*{spdx}"
        grant = rf"licen[cs]ed\s+under\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?(?:{name}){LICENCE}"
        for v in versions:
            number = v.replace(".", r"\.")
            short = number.removesuffix(r"\.0")
            version = rf",?\s+(?:version\s+|v\.?\s*)?(?:{number}|{short})"
            add(1, f"{label}-{v}", spdx, rf"{tag}-(?:{number}|{short})(?:-clause|-only|-or-later|\+)?")
            add(1, f"{label}-{v}", keyword, rf"{grant}{version}")
            add(3, f"{label}-{v}", keyword, rf"(?:{name}){LICENCE}{version}")
        add(1, label, spdx, tag)
        add(1, label, keyword, grant)
        # Of several addresses only the end of the host is sure to be shared.
        host = ".org" if "|" in address else address.split("\\")[0].split("/")[0].split("(")[0]
        add(2, label, host, rf"(?:{address})\S*")
        add(4, label, keyword, rf"(?:{name}){LICENCE}")
    return rules


def lowered(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def _intervals(text: Column, rule: Column) -> Column:
    """All matches of a rule as start, -end, priority, label."""
    between = F.call_function("split", text, rule["pattern"], F.lit(-1))
    found = F.regexp_extract_all(text, rule["pattern"], F.lit(0))
    empty = F.array().cast("array<struct<start:int,back:int,priority:int,label:string>>")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        one = F.struct(start.alias("start"), (-end).alias("back"), rule["priority"].alias("priority"), rule["label"].alias("label"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    pairs = F.zip_with(
        F.slice(between, F.lit(1), F.size(found)), found, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit"))
    )
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    return F.aggregate(pairs, start, step, lambda s: s["out"])


def _unsuppressed(found: Column) -> Column:
    """Intervals no stronger or earlier equal interval contains; ``found`` is sorted by start, then longest."""
    levels = sorted(WEIGHTS)
    kind = "array<struct<start:int,back:int,priority:int,label:string>>"
    start = F.struct(*[F.lit(-1).alias(f"end{p}") for p in levels], F.array().cast(kind).alias("out"))

    def step(state: Column, x: Column) -> Column:
        end = -x["back"]
        covered = F.lit(False)
        for p in levels:
            covered = covered | ((x["priority"] >= p) & (state[f"end{p}"] >= end))
        ends = [F.when(x["priority"] == p, F.greatest(state[f"end{p}"], end)).otherwise(state[f"end{p}"]).alias(f"end{p}") for p in levels]
        return F.struct(*ends, F.when(covered, state["out"]).otherwise(F.concat(state["out"], F.array(x))).alias("out"))

    return F.aggregate(found, start, step, lambda s: s["out"])


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", rules: list[dict] | None = None) -> DataFrame:
    """``key, n_words, places`` (of each base phrase: count, first and last word) and ``detections``."""
    table = F.from_json(
        F.lit(json.dumps(rules or signature_rules())), "array<struct<priority:int,label:string,keyword:string,pattern:string>>"
    )
    raw = F.coalesce(F.col(text), F.lit(""))
    gated = raw.rlike("(?i)" + "|".join(GATE))
    first = df.select(F.col(key), F.regexp_count(raw, F.lit(_WORD)).cast("long").alias("n_words"), F.when(gated, lowered(raw)).alias("_low"))
    # Every word has a blank of its own on both sides, so phrases cannot share one.
    joined = F.concat(F.lit(" "), F.array_join(F.regexp_extract_all("_low", F.lit(_WORD), F.lit(0)), "  "), F.lit(" "))
    words = first.withColumn("_words", joined)
    places = []
    for label, phrase in BASE:
        sought = "".join(f" {w} " for w in phrase)
        n = ((F.length("_words") - F.length(F.replace("_words", F.lit(sought), F.lit("")))) / len(sought)).cast("long")
        before = (_spaces(F.substring_index("_words", sought, 1)) / 2).cast("long")
        after = (_spaces(F.substring_index("_words", sought, -1)) / 2).cast("long")
        places.append(
            F.struct(
                F.lit(label).alias("label"),
                F.coalesce(n, F.lit(0)).alias("n"),
                F.when(n > 0, before).alias("first"),
                F.when(n > 0, F.col("n_words") - after - len(phrase)).alias("last"),
            )
        )
    asked = F.filter(table, lambda r: F.contains(F.col("_low"), r["keyword"]))
    found = F.array_sort(F.flatten(F.transform(asked, lambda r: _intervals(F.col("_low"), r))))
    return words.select(
        key,
        "n_words",
        F.array(*places).alias("places"),
        F.when(F.col("_low").isNotNull(), _unsuppressed(found)).alias("detections"),
    )
