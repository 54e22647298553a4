"""Secret scans: fixed patterns plus a randomness test battery.

Everything is a DataFrame expression on the row of a text.  Candidate tokens
(long runs of key characters) are tested for being uniformly random in their
inferred encoding: chi-squared over the alphabet, runs about the middle of the
alphabet, lag-one serial correlation, and for runs of letters the likelihood
ratio of ordinary writing.  A token is ordinary if randomness is rejected; the
rejections are controlled per encoding and length class by the
Benjamini-Hochberg rule on binned p-values, and tokens too short for the tests
to reject ordinary writing are never called secret.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daycast.llm.carry import packed, unpacked
from daycast.llm.words import text_of

# Patterns of the base kinds, in their order.
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
          r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
#: Characters of an assigned value, or it is no secret.
LEAST_VALUE = 6

def _run(chars: str, around: str) -> str:
    """A whole run of ``chars`` with none of ``around`` beside it; padding belongs to it at the end only."""
    return rf"(?<![{around}])[{chars}]{{20,}}+(?:=++(?![{_ANY}]))?(?![{around}])"


_ANY = "A-Za-z0-9+/_-"
#: Candidates of the battery: whole runs of base64 characters or, where '-' or '_' stand beside them, what lies between
#: slashes; runs of base64url characters; runs of letters and digits.  '=' between characters is an assignment.
TOKENS = (_run("A-Za-z0-9+/", _ANY) + "|" + _run("A-Za-z0-9+", "A-Za-z0-9+_-"), _run("A-Za-z0-9_-", "A-Za-z0-9_-"), _run("A-Za-z0-9", "A-Za-z0-9"))
#: Every candidate, and every span of the kinds "access" and "hex", lies in such a run.
LONG = rf"(?<![{_ANY}])[{_ANY}]{{20}}"
#: What every "assign" match has behind its name: the name's last letter, the sign and a value.
GIVEN_VALUE = r"""[DdTtNnYy]["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]"""
#: Alphabets in code order.
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "decimal": _DIGITS,
    "hex": _DIGITS + "abcdef",
    "hex_upper": _DIGITS + "ABCDEF",
    "lower": _LOWER,
    "upper": _UPPER,
    "base32": _UPPER + "234567",
    "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
#: Repeat rate of letters in ordinary writing (sum of squared letter shares).
ORDINARY = 0.065
#: Letters of ordinary writing, a to z in per mille, and their share in the alternative (the rest is uniform, for other languages).
LETTERS = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)
ORDINARY_SHARE = 0.8
_LOGS = [math.log(26 * (ORDINARY_SHARE * c / sum(LETTERS) + (1 - ORDINARY_SHARE) / 26)) for c in LETTERS]
_LOG_MEAN = sum(_LOGS) / 26
_LOG_VAR = sum((x - _LOG_MEAN) ** 2 for x in _LOGS) / 26
#: Least lengths of runs of letters alone, and of upper-case hex (as that of the base kind).
LEAST = {"lower": 32, "upper": 32, "hex_upper": 24}
#: Share of falsely rejected tokens among the rejected.
FDR = 0.05
#: p-value bins per decade and their number.
BINS, MOST_BINS = 10, 300
#: Spans whose offsets are summed in one go.
BLOCK = 512


def _offsets(lengths: Column) -> Column:
    """Running sum before each element; blocks keep the work linear."""
    n = F.size(lengths)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))

    def running(xs: Column, at: Column) -> Column:
        begin = F.struct(F.array().cast("array<int>").alias("out"), at.cast("int").alias("at"))
        return F.aggregate(xs, begin, lambda a, x: F.struct(
            F.concat(a["out"], F.array(a["at"])).alias("out"), (a["at"] + x).alias("at")))["out"]

    sums = F.transform(blocks, lambda s: F.aggregate(s, F.lit(0), lambda a, x: a + x))
    return F.when(n > 0, F.flatten(F.zip_with(blocks, running(sums, F.lit(0)), running))).otherwise(F.array().cast("array<int>"))


def _located(df: DataFrame, name: str, pattern: str, value: int = 0, maybe: str | None = None) -> DataFrame:
    """Adds ``name``: array of (start, end, value) of the leftmost non-overlapping matches, in code points.

    Where the column ``maybe`` is false, nothing can match.
    """
    text, p = F.col("_text"), F.lit(pattern)
    none = F.array().cast("array<string>")
    hit = F.col(maybe) & text.rlike(pattern) if maybe else text.rlike(pattern)
    df = df.withColumns({"_m": F.when(hit, F.regexp_extract_all(text, p, F.lit(0))).otherwise(none),
                         "_gap": F.when(hit, F.split(text, pattern, -1)).otherwise(none)})
    df = df.withColumn("_v", F.when(hit, F.regexp_extract_all(text, p, F.lit(value))).otherwise(none) if value else F.col("_m"))
    df = df.withColumn("_at", _offsets(F.zip_with(F.slice("_gap", F.lit(1), F.size("_m")), "_m",
                                                  lambda g, m: F.length(g) + F.length(m))))
    located = F.transform("_m", lambda m, i: F.struct(
        (F.get("_at", i) + F.length(F.get("_gap", i))).alias("start"),
        (F.get("_at", i) + F.length(F.get("_gap", i)) + F.length(m)).alias("end"),
        F.get("_v", i).alias("value")))
    return df.withColumn(name, located).drop("_m", "_gap", "_v", "_at")


def _marked(df: DataFrame) -> DataFrame:
    """Adds ``_maybe``: has the text a run long enough for any span but an assigned value?"""
    return df.withColumn("_maybe", F.col("_text").rlike(LONG))


def _base(docs: DataFrame) -> DataFrame:
    """Adds ``_text``, ``_maybe`` and one array of spans per base kind."""
    df = _marked(docs.withColumn("_text", text_of("text"))).withColumn("_given", F.col("_text").rlike(GIVEN_VALUE))
    df = _located(df, "_assign", ASSIGN, 2, maybe="_given")
    # these two match whole runs, so the least length can stand in the pattern
    df = _located(df, "_access", ACCESS, maybe="_maybe")
    df = _located(df, "_hex", HEX, maybe="_maybe")
    return df.withColumn("_assign", F.filter("_assign", lambda s: F.length(s["value"]) >= LEAST_VALUE)).drop("_given")


# ---- battery --------------------------------------------------------------


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution (rational approximation, relative error below 1e-4 for z >= 0)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    q = F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, q).otherwise(1 - q)


def _encoding(tok: Column) -> Column:
    """Smallest alphabet that holds the token (padding aside)."""
    out = None
    for name, chars in ALPHABETS.items():
        chars = chars.replace("-", r"\-").replace("/", r"\/")
        cond = tok.rlike(f"^[{chars}]+=*$")
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out


def _alphabet(enc: Column) -> Column:
    out = None
    for name, chars in ALPHABETS.items():
        out = F.when(enc == name, F.lit(chars)) if out is None else out.when(enc == name, F.lit(chars))
    return out


def _inferred(x: Column) -> Column:
    enc = _encoding(x["value"])
    return F.struct(x["start"].alias("start"), x["end"].alias("end"), F.regexp_replace(x["value"], "=+$", "").alias("tok"), enc.alias("enc"))


def _measured(x: Column) -> Column:
    """Adds length, alphabet and the token as places in its alphabet."""
    return F.struct(x["start"].alias("start"), x["end"].alias("end"), x["tok"].alias("tok"), x["enc"].alias("enc"),
                    F.length(x["tok"]).cast("double").alias("n"), _alphabet(x["enc"]).alias("chars"))


def _placed(x: Column) -> Column:
    chars, n = x["chars"], x["n"]
    places = F.transform(F.filter(F.split(x["tok"], ""), lambda c: c != ""), lambda c: (F.instr(chars, c) - 1).cast("double"))
    squares = F.aggregate(F.filter(F.split(chars, ""), lambda c: c != ""), F.lit(0.0), lambda a, c: a + F.pow(
        n - F.length(F.replace(x["tok"], c, F.lit(""))), F.lit(2.0)))
    return F.struct(x["start"].alias("start"), x["end"].alias("end"), x["enc"].alias("enc"), n.alias("n"),
                    F.length(chars).cast("double").alias("k"), places.alias("places"), squares.alias("squares"))


def _sums(x: Column) -> Column:
    """Sums over the token for the runs and serial tests."""
    begin = F.struct(*[F.lit(v).alias(c) for c, v in
                       (("last", -1.0), ("first", -1.0), ("high", 0.0), ("runs", 0.0), ("s", 0.0), ("ss", 0.0), ("sl", 0.0))])

    def step(a: Column, v: Column) -> Column:
        half, new = x["k"] / 2, a["first"] < 0
        return F.struct(v.alias("last"), F.when(new, v).otherwise(a["first"]).alias("first"),
                        (a["high"] + F.when(v >= half, 1.0).otherwise(0.0)).alias("high"),
                        (a["runs"] + F.when(new | ((v >= half) != (a["last"] >= half)), 1.0).otherwise(0.0)).alias("runs"),
                        (a["s"] + v).alias("s"), (a["ss"] + v * v).alias("ss"),
                        (a["sl"] + F.when(new, 0.0).otherwise(a["last"] * v)).alias("sl"))

    return F.struct(x["start"].alias("start"), x["end"].alias("end"), x["enc"].alias("enc"), x["n"].alias("n"), x["k"].alias("k"),
                    x["squares"].alias("squares"), F.aggregate(x["places"], begin, step).alias("a"),
                    F.when(x["enc"].isin("lower", "upper"), F.aggregate(
                        x["places"], F.lit(0.0), lambda a, v: a + F.get(F.array(*map(F.lit, _LOGS)), v.cast("int")))).alias("written"))


def _verdict(x: Column) -> Column:
    """``start, end, group, bin``: p-value bin and control group."""
    n, k, a = x["n"], x["k"], x["a"]
    df = k - 1
    chi2 = k / n * x["squares"] - n
    z_chi = (F.pow(F.greatest(chi2, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    mid = 2 * a["high"] * (n - a["high"])
    var = mid * (mid - n) / (n * n * (n - 1))
    p_runs = F.when(var <= 0, 0.0).otherwise(2 * _tail(F.abs(a["runs"] - mid / n - 1) / F.sqrt(F.greatest(var, F.lit(1e-9)))))
    mean = a["s"] / n
    spread = a["ss"] - n * mean * mean
    lag = a["sl"] - mean * (2 * a["s"] - a["first"] - a["last"]) + (n - 1) * mean * mean
    p_lag = F.when(spread <= 0, 0.0).otherwise(2 * _tail(F.abs(lag / F.greatest(spread, F.lit(1e-9)) + 1 / n) * F.sqrt(n)))
    # letters alone: how much likelier ordinary writing is than random letters
    p_written = _tail((x["written"] - n * _LOG_MEAN) / F.sqrt(n * _LOG_VAR))
    p = F.least(F.lit(1.0), F.when(x["written"].isNull(), 3).otherwise(4) * F.least(_tail(z_chi), p_runs, p_lag, p_written))
    return F.struct(x["start"].alias("start"), x["end"].alias("end"),
                    F.concat(x["enc"], F.lit(":"), F.floor(F.log2(n)).cast("string")).alias("group"),
                    F.least(F.lit(MOST_BINS), F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * BINS)).cast("int").alias("bin"))


def _testable(x: Column) -> Column:
    """Where ordinary writing would pass the tests, passing them says nothing."""
    power = x["n"] * (F.length(x["chars"]) * ORDINARY - 1) / F.sqrt(2.0 * (F.length(x["chars"]) - 1))
    own = F.lit(False)
    for enc, least in LEAST.items():
        own = own | ((x["enc"] == enc) & (x["n"] >= least))
    return x["enc"].isNotNull() & (own | (~x["enc"].isin("decimal", "hex", *LEAST) & (x["n"] >= 20) & (power >= 4)))


def _candidates(df: DataFrame) -> DataFrame:
    """Adds ``_tested``, the verdicts of the battery; needs ``_text, _maybe``."""
    for i, pattern in enumerate(TOKENS):
        df = _located(df, f"_tokens{i}", pattern, maybe="_maybe")
    names = [f"_tokens{i}" for i in range(len(TOKENS))]
    # a run of letters of both cases needs them mixed to be more than a word
    mixed = F.filter(F.array_distinct(F.concat(*names)), lambda x: x["value"].rlike("[0-9]|[a-z][A-Z][a-z]|^([a-z]+|[A-Z]+)=*$"))
    ready = F.filter(F.transform(F.transform(mixed, _inferred), _measured), _testable)
    return df.withColumn("_tested", F.transform(F.transform(F.transform(ready, _placed), _sums), _verdict)).drop("_maybe", *names)


def _limits(tested: DataFrame) -> DataFrame:
    """``group, limit``: the first p-value bin at which randomness counts as rejected (Benjamini-Hochberg per group)."""
    # explode() would have the optimizer infer a filter on the array's size, and push it below with the battery in it again and again
    each = tested.select(F.explode_outer("_tested").alias("x")).filter("x is not null")
    bins = each.groupBy("x.group", "x.bin").agg(F.count(F.lit(1)).alias("c"))
    above = W.partitionBy("group").orderBy(F.desc("bin"))
    everything = W.partitionBy("group")
    ranked = bins.withColumns({"r": F.sum("c").over(above), "m": F.sum("c").over(everything)})
    ok = F.pow(F.lit(10.0), -F.col("bin") / BINS) <= FDR * F.col("r") / F.col("m")
    return ranked.groupBy("group").agg(F.min(F.when(ok, F.col("bin"))).alias("limit"))


def scan(docs: DataFrame) -> DataFrame:
    """All documents with ``spans``: array of (start, kind, end), by start, then kind in the order of ``KINDS``.

    Offsets are code points, ends exclusive; ``kind`` is an index into
    ``KINDS``.  The battery adds spans of kind ``random`` that overlap no base
    span and lie in no longer one; base spans always stay.  Needs ``text``; other columns pass whatever their
    names (a column ``spans`` is replaced).  NULL and empty texts have no spans, equal texts
    equal spans, an empty table stays empty.  The documents are read twice: the
    first pass counts p-values per (encoding, length class), a table of at most
    a few hundred limits that the second pass gets as one scalar.
    """
    return unpacked(_scanned(packed(docs)), docs, {"spans": F.col("spans")})


def _scanned(docs: DataFrame) -> DataFrame:
    limits = (_limits(_candidates(_marked(docs.select(text_of("text").alias("_text"))).filter("_maybe")))
              .agg(F.map_from_entries(F.collect_list(F.struct("group", F.coalesce("limit", F.lit(MOST_BINS + 1)))))).scalar())
    df = _candidates(_base(docs)).withColumn("_limits", limits)

    def spans(c: str, kind: int) -> Column:
        return F.transform(c, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    base = F.concat(spans("_assign", 0), spans("_access", 1), spans("_hex", 2))
    random = F.filter("_tested", lambda x: x["bin"] < F.coalesce(F.try_element_at("_limits", x["group"]), F.lit(MOST_BINS + 1)))
    df = df.withColumns({"_base": base, "_random": random})
    free = F.filter("_random", lambda x: ~F.exists("_base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    df = df.withColumn("_random", free)
    longest = F.filter("_random", lambda x: ~F.exists("_random", lambda y: (
        (y["start"] <= x["start"]) & (x["end"] <= y["end"]) & (y["end"] - y["start"] > x["end"] - x["start"]))))
    df = df.withColumn("_random", longest)
    return df.withColumn("spans", F.sort_array(F.concat("_base", spans("_random", 3)))).select(*docs.columns, "spans")


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op7_secrets(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return scan(docs).select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                             F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """Documents whose secrets are replaced by ``mark`` (overlapping spans by one); ``n_chars``, if there, follows.

    The other columns pass as given, also one named ``spans``.  NULL texts stay
    NULL and empty ones empty, repeated rows stay and are equal, an empty table
    stays empty.
    """
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(a: Column, s: Column) -> Column:
        gap = F.when(s["start"] > a["at"], F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"])).otherwise("")
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"),
                        F.when(s["end"] <= a["at"], a["parts"])
                        .when((s["start"] < a["at"]) & (F.size(a["parts"]) > 0), a["parts"])
                        .otherwise(F.concat(a["parts"], F.array(gap, F.lit(mark)))).alias("parts"))

    done = F.aggregate("spans", begin, step, lambda a: F.concat(
        F.array_join(a["parts"], ""), F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    out = _scanned(packed(docs)).withColumn("_clean", F.when(F.size("spans") > 0, done).otherwise(F.col("text")))
    length = {"n_chars": F.length("_clean").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return unpacked(out, docs, {"text": F.col("_clean"), **length})


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: secrets are blanked out, no document goes (NULLs, repeated rows and other columns as in ``redact``)."""
    return redact(docs)
