"""Secret scan: fixed patterns plus a battery of randomness tests.

Everything is a column expression or an aggregation.  Texts are scanned
whole.  A candidate token of the battery is a long run of token characters
that no pattern match overlaps.  Its encoding is inferred from its
characters; three statistics are compared with what ordinary text of that
length gives in that encoding:

* chi-squared of the character counts against a uniform alphabet,
* the number of runs of one character class (lower, upper, digit),
* the lag-1 serial correlation of the class sequence.

Where all characters are of one such class, others that vary stand in: digits
up to 4 and beyond; rare and common letters for the runs, vowels and consonants
for the correlation (text alternates them, random letters don't).

Random strings lie far below ordinary text in all three.  The combined
p-value is the chance that ordinary text looks as random.  Within each
length class the false discovery rate is held over the whole corpus by the
step-up rule on a histogram of p-values (a table of bounded size).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from priceloom.functions.numerics import _ERFC_COEFFS
from priceloom.llm.common import documents

# The kinds and patterns of the base spans.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
MIN_CHARS = {"assign": 6, "access": 20, "hex": 24}

# Shortest token the battery judges, and its false discovery rate.
TOKEN_CHARS = 20
FDR = 1e-3
TOKEN = r"[A-Za-z0-9+/_=-]{%d,}" % TOKEN_CHARS

# Per encoding: alphabet size; excess of text's chi-squared per character;
# chance that neighbouring characters of text differ in class; lag-1
# correlation of text's classes; 1 if random strings have less of it, -1 if more.  The excess is A * sum(p^2) - 1 with
# sum(p^2) = 1/15, the repeat rate of letters in European text.
BACKGROUND = {
    "decimal": (10, 0.5, 0.10, 0.5, 1), "hex": (16, 1.0, 0.15, 0.5, 1), "base32": (32, 1.13, 0.10, 0.5, 1),
    "letters": (26, 0.73, 0.24, -0.2, -1), "base64": (64, 3.27, 0.10, 0.5, 1),
}
RARE, VOWELS = "bfgjkpqvwxyz", "aeiou"
LENGTH_CLASSES = (24, 32, 40, 64, 128)  # upper bounds; one more class beyond
BINS_PER_DECADE, MAX_BIN = 10, 400

_SPAN = "struct<s:bigint,kind:int,e:bigint>"


def _located(text: Column, pattern: str, found: Column) -> Column:
    """(s, e, m) of each match, in code points: the pieces between matches
    and the matches alternate, so their lengths add up to the places."""
    pieces = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.greatest(F.size(found), F.lit(0))), found,
                        lambda gap, m: F.struct(F.length(gap).cast("bigint").alias("g"), m.alias("m")))
    start = F.expr("named_struct('at', 0L, 'out', cast(array() as array<struct<s:bigint,e:bigint,m:string>>))")

    def add(acc: Column, p: Column) -> Column:
        s = acc["at"] + p["g"]
        e = s + F.length(p["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), p["m"].alias("m")))).alias("out"))

    empty = F.expr("cast(array() as array<struct<s:bigint,e:bigint,m:string>>)")
    return F.when(F.size(found) > 0, F.aggregate(pieces, start, add, lambda acc: acc["out"])).otherwise(empty)


def _spans(matches: Column, kind: str, enough) -> Column:
    k = KINDS.index(kind)
    return F.transform(F.filter(matches, enough), lambda m: F.struct(m["s"].alias("s"), F.lit(k).alias("kind"), m["e"].alias("e")))


def with_base_spans(df: DataFrame, text: str = "_text") -> DataFrame:
    """Adds ``_base``: the pattern matches as (s, kind, e), in order."""
    t = F.col(text)
    # matches first, then their places: each is a column of its own, so that no pattern runs twice
    hexes = r"[0-9a-f]{%d,}" % MIN_CHARS["hex"]  # a run of characters is its own maximal match
    df = df.select("*", F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(0)).alias("_m0"),
                   F.regexp_extract_all(t, F.lit(ACCESS), F.lit(0)).alias("_m1"),
                   F.regexp_extract_all(t, F.lit(hexes), F.lit(0)).alias("_m2"))
    value = lambda m: F.length(F.regexp_extract(m["m"], "^" + ASSIGN, 2)) >= MIN_CHARS["assign"]
    long_key = lambda m: F.length(m["m"]) >= MIN_CHARS["access"]
    every = lambda m: F.lit(True)
    base = F.concat(_spans(_located(t, ASSIGN, F.col("_m0")), "assign", value),
                    _spans(_located(t, ACCESS, F.col("_m1")), "access", long_key),
                    _spans(_located(t, hexes, F.col("_m2")), "hex", every))
    return df.withColumn("_base", F.array_sort(base)).drop("_m0", "_m1", "_m2")


def _class(ch: Column) -> Column:
    return (F.when(ch.between("a", "z"), 0).when(ch.between("A", "Z"), 1).when(ch.between("0", "9"), 2).otherwise(3)).cast("double")


def _classes(ch: Column, enc: Column, letters: str) -> Column:
    """The classes of characters that aren't separators."""
    one = lambda c: (F.when(enc == "decimal", (c >= "5").cast("double"))
                     .when(enc == "letters", F.contains(F.lit(letters), F.lower(c)).cast("double")).otherwise(_class(c)))
    return F.transform(F.filter(ch, lambda c: _class(c) < 3), one)  # separators are no class of their own


def _encoding(m: Column) -> Column:
    return (F.when(m.rlike("^[0-9]+$"), "decimal").when(m.rlike("^([a-z_-]+|[A-Z_-]+|[A-Z][a-z_-]+)=*$"), "letters")
            .when(m.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex").when(m.rlike("^[A-Z2-7]+=*$"), "base32").otherwise("base64"))


def _background(enc: Column, k: int) -> Column:
    table = F.create_map(*[F.lit(x) for name, values in BACKGROUND.items() for x in (name, float(values[k]))])
    return F.element_at(table, enc)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda x, y: x + y)


def _scored(tokens: Column) -> Column:
    """Adds z to each token: how far below ordinary text its statistics lie."""
    sub = lambda a, k: F.slice(a, F.lit(k), F.greatest(F.size(a) - 1, F.lit(0)))
    tokens = F.transform(tokens, lambda t: F.struct(t["s"].alias("s"), t["e"].alias("e"), t["m"].alias("m"),
                                                    F.length(t["m"]).cast("double").alias("n"), _encoding(t["m"]).alias("enc"),
                                                    F.split(t["m"], "(?!^)").alias("ch")))
    tokens = F.transform(tokens, lambda t: F.struct(
        t["s"].alias("s"), t["e"].alias("e"), t["n"].alias("n"),
        *[_background(t["enc"], k).alias(x) for k, x in enumerate(("size", "excess", "tau", "rho", "sign"))],
        _classes(t["ch"], t["enc"], RARE).alias("runs"), _classes(t["ch"], t["enc"], VOWELS).alias("cl"),
        F.aggregate(F.array_distinct(t["ch"]), F.lit(0.0),
                    lambda acc, c: acc + F.pow(t["n"] - F.length(F.replace(t["m"], c, F.lit(""))), F.lit(2.0))).alias("squares")))
    tokens = F.transform(tokens, lambda t: F.struct(
        *[t[x].alias(x) for x in ("s", "e", "n", "size", "excess", "tau", "rho", "sign", "squares")], (_sum(t["cl"]) / F.greatest(F.size(t["cl"]), F.lit(1))).alias("mean"),
        F.greatest(F.size(t["cl"]) - 1, F.lit(1)).cast("double").alias("pairs"),
        sub(t["runs"], 1).alias("from"), sub(t["runs"], 2).alias("to"),
        sub(t["cl"], 1).alias("head"), sub(t["cl"], 2).alias("tail"), t["cl"].alias("cl")))
    tokens = F.transform(tokens, lambda t: F.struct(
        *[t[x].alias(x) for x in ("s", "e", "n", "tau", "rho", "sign", "pairs")],
        ((t["squares"] * t["size"] / t["n"] - t["n"] - (t["size"] - 1 + t["n"] * t["excess"]))
         / F.sqrt(2 * (t["size"] - 1) + 4 * t["n"] * t["excess"])).alias("z_chi"),
        _sum(F.zip_with(t["from"], t["to"], lambda a, b: F.when(a == b, 0.0).otherwise(1.0))).alias("changes"),
        (_sum(F.transform(t["cl"], lambda a: F.pow(a - t["mean"], F.lit(2.0)))) / (t["pairs"] + 1)).alias("var"),
        (_sum(F.zip_with(t["head"], t["tail"], lambda a, b: (a - t["mean"]) * (b - t["mean"]))) / t["pairs"]).alias("cov")))

    def z(t: Column) -> Column:
        runs = (t["pairs"] * t["tau"] - t["changes"]) / F.sqrt(t["pairs"] * t["tau"] * (1 - t["tau"]))
        order = F.when(t["var"] > 0, t["sign"] * (t["cov"] / t["var"] - t["rho"])).otherwise(0.5)  # one class only: as ordered as can be
        return (t["z_chi"] + runs + order * F.sqrt(t["n"])) / math.sqrt(3.0)

    tokens = F.transform(tokens, lambda t: F.struct(t["s"].alias("s"), t["e"].alias("e"), z(t).alias("z")))
    tokens = F.transform(tokens, lambda t: F.struct(t["s"].alias("s"), t["e"].alias("e"), t["z"].alias("z"),
                                                    (1 / (1 + 0.5 * F.abs(t["z"]) / math.sqrt(2.0))).alias("t")))
    return F.transform(tokens, lambda t: F.struct(t["s"].alias("s"), t["e"].alias("e"), t["z"].alias("z"), _tail(t["z"], t["t"]).alias("tail")))


def _tail(z: Column, t: Column) -> Column:
    """P(Z >= |z|), the series of ``erfc_nonneg`` on a ready-made t."""
    poly = F.lit(_ERFC_COEFFS[-1])
    for c in reversed(_ERFC_COEFFS[:-1]):
        poly = F.lit(c) + t * poly
    return 0.5 * t * F.exp(-z * z / 2 + poly)


def _p_bin(t: Column) -> Column:
    """-log10 of P(Z <= z), in tenths, 0 to MAX_BIN."""
    p = F.when(t["z"] < 0, t["tail"]).otherwise(1.0 - t["tail"])
    return F.least(F.greatest(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * BINS_PER_DECADE), F.lit(0)), F.lit(MAX_BIN)).cast("int")


def _length_class(n: Column) -> Column:
    out = F.lit(len(LENGTH_CLASSES))
    for k, most in reversed(list(enumerate(LENGTH_CLASSES))):
        out = F.when(n <= most, k).otherwise(out)
    return out


def with_candidates(df: DataFrame, text: str = "_text") -> DataFrame:
    """Adds ``_cand``: (s, e, cls, bin) of each token that no base span overlaps."""
    df = df.withColumn("_m3", F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(0)))
    df = df.withColumn("_tok", _located(F.col(text), TOKEN, F.col("_m3")))
    df = df.withColumn("_tok", F.filter("_tok", lambda t: ~F.exists("_base", lambda b: (b["s"] < t["e"]) & (t["s"] < b["e"]))))
    scored = F.transform(_scored(F.col("_tok")), lambda t: F.struct(
        t["s"].alias("s"), t["e"].alias("e"), _length_class(t["e"] - t["s"]).alias("cls"), _p_bin(t).alias("bin")))
    return df.withColumn("_cand", scored).drop("_m3", "_tok")


def thresholds(cands: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """The smallest p-value bin that is a discovery, by length class.

    Step-up rule over all tests of the class: the least strict bin t with
    tests * 10^-t <= fdr * (tests at t or beyond).  The table that comes to
    the driver has one cell per class and bin, whatever the input."""
    cells = (cands.select(F.explode("_cand").alias("c")).groupBy(F.col("c.cls").alias("cls"), F.col("c.bin").alias("bin"))
             .agg(F.count(F.lit(1)).alias("n")).collect())
    out = {}
    for cls in sorted({r["cls"] for r in cells}):
        own = sorted(((r["bin"], r["n"]) for r in cells if r["cls"] == cls), reverse=True)
        tests, beyond = sum(n for _, n in own), 0
        for b, n in own:
            beyond += n
            if tests * 10 ** (-b / BINS_PER_DECADE) <= fdr * beyond:
                out[cls] = b
    return out


def _discovered(limits: dict[int, int]) -> Column:
    k = KINDS.index("random")

    def enough(c: Column) -> Column:
        limit = F.lit(MAX_BIN + 1)
        for cls, b in limits.items():
            limit = F.when(c["cls"] == cls, F.lit(b)).otherwise(limit)
        return c["bin"] >= limit

    return F.transform(F.filter("_cand", enough), lambda c: F.struct(c["s"].alias("s"), F.lit(k).alias("kind"), c["e"].alias("e")))


def _listed(spans: Column) -> Column:
    kind = lambda x: F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["kind"] + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", kind(x), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random for every input row.

    Null and empty texts have no spans; repeated rows are listed as often as
    they occur, null ids too; an empty table gives an empty result.  Places
    are in code points, end exclusive."""
    rows = documents(docs, id_col, text_col).withColumn("_text", F.coalesce("_text", F.lit("")))
    found = with_candidates(with_base_spans(rows))
    limits = thresholds(found, fdr)
    found = found.withColumn("_all", F.array_sort(F.concat("_base", _discovered(limits))))
    count = lambda k: F.size(F.filter("_all", lambda x: x["kind"] == k)).cast("bigint")
    return found.select(F.col("_id").alias("doc_id"), *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
                        F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"), _listed(F.col("_all")).alias("spans"),
                        count(3).alias("n_random"))


def redact(docs: DataFrame, text_col: str = "text", fdr: float = FDR, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found secret replaced by ``mark`` (overlapping
    spans by one); all rows stay, other columns are unchanged.  A null text
    stays null."""
    rows = docs.withColumn("_text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    found = with_candidates(with_base_spans(rows))
    limits = thresholds(found.select("_cand"), fdr)
    found = found.withColumn("_all", F.array_sort(F.concat("_base", _discovered(limits))))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def cut(acc: Column, x: Column) -> Column:
        fresh = x["s"] >= acc["at"]
        gap = F.substring(F.col("_text"), (acc["at"] + 1).cast("int"), (x["s"] - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("_text"), (acc["at"] + 1).cast("int"), F.length("_text")))
    clean = F.when(F.size("_all") > 0, F.aggregate("_all", start, cut, rest)).otherwise(F.col(text_col))
    return found.withColumn(text_col, clean).drop("_text", "_base", "_cand", "_all")
