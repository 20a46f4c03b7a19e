"""Secrets in texts: fixed forms, and tokens that a Markov model finds more like random strings than like identifiers.

Three kinds have fixed forms (assigned secrets, access keys, long hexadecimal runs).  These are cut out of the text; a
fourth kind, ``markov``, is any token of ``LEAST`` characters or more in what is left whose log-likelihood ratio a
character beats the threshold, or else each stretch of ``LEAST`` characters or more of it that does: transition
probabilities of one model come from labelled random strings, those of the other from labelled ordinary identifiers.
Both models are counts of character pairs, taken in one aggregate each; at most 128 x 128 pairs reach the driver, whatever
the size of the samples.  A step from one character to the next has two parts: from one class (small letters, capitals,
digits, separators) to the next, and, among letters, from one letter to the next in either case.  Digits are a class
without inner order, so a run of them speaks for ordinary identifiers however its digits follow each other.

Identifiers come in shapes that words have in names: as they stand, capitalised, in capitals, joined by case or underscores, with
numbers, dates and counters.  UUIDs are random by design and no secrets; they are cut out like the fixed forms.

All of it is built-in functions: matches and the gaps between them give positions in code points.  A text without a
match of a kind costs one search and no more.

Nulls: a null text is an empty one.  Repeated rows are scanned alike.  Further columns stay.  An empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wireloom.llm.storage import stored

# Fixed forms; a match shorter than its least length is dropped, not shortened.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
KINDS = ["assign", "access", "hex", "markov"]

#: Tokens that the models judge.
TOKEN = "[A-Za-z0-9+/_=-]"
LEAST = 20
#: Log-likelihood ratio a character, in favour of random strings, from which a token is a secret.
THRESHOLD = 0.9
#: Characters between the words of a path or name; inside a stretch they speak for neither model.
SEPARATORS = "/=_-+"
#: Most that one character of a stretch counts for random strings: a date in a path is no secret.
CLIP = 5.0
#: Words at the edge of a stretch are left out if the ratios beyond the threshold of their characters add up to less than minus this.
EDGE = 4.0
#: Cut out before tokens are judged: random by design, but no secret.
UUID = "(?<![0-9A-Za-z])[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}(?![0-9A-Za-z])"
#: Part of the probability of a letter that does not depend on the one before: unknown words are no random strings.
ANY_LETTER = 0.25
#: Random strings that are made for training, half of them over letters and digits, half in hexadecimal.
RANDOM_STRINGS = 20_000
#: Ordinary identifiers that are taken for training at most: distinct words of as many documents.
IDENTIFIER_DOCUMENTS = 2_000
# Runs of one character class have no shorter match before or after a long one, so searching long runs alone finds the same.
HEX_LONG = f"[0-9a-f]{{{LEAST_HEX},}}"
TOKEN_LONG = f"{TOKEN}{{{LEAST},}}"
SYMBOLS = 128
#: Stands before the first character of a token.
START = 0


def random_strings(spark: SparkSession, many: int = RANDOM_STRINGS) -> DataFrame:
    """Labelled random strings (``token``), the same in every run."""
    seeded = spark.range(many).select(F.sha2(F.col("id").cast("string"), 256).alias("h"), "id")
    text = F.when(F.col("id") % 2 == 0, F.substring(F.base64(F.unhex("h")), 1, 40)).otherwise(F.substring("h", 1, 40))
    return seeded.select(text.alias("token"))


def identifiers(docs: DataFrame, text_col: str = "text", most: int = IDENTIFIER_DOCUMENTS) -> DataFrame:
    """Labelled ordinary identifiers (``token``): distinct words of a bounded sample of documents, in the shapes of names.

    The sample holds the texts with the least hashes (copies of a text count once towards the bound), so it does not
    depend on how the table is split.  It is stored, so that whole texts are read twice and no more.
    """
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t")).withColumn("h", F.xxhash64("t"))
    last = texts.select("h").distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]  # hashes alone meet in one task
    sample = texts.filter(F.col("h") <= F.lit(last).cast("bigint")).dropDuplicates(["h"])
    words = sample.select(F.explode(F.split("t", r"[^A-Za-z]+")).alias("w")).filter("length(w) > 1").distinct()
    words = stored(words.select(F.lower("w").alias("w")).distinct().withColumn("n", F.pmod(F.xxhash64("w"), F.lit(1_000_000))), "words")
    w, title, n = F.col("w"), F.initcap("w"), F.col("n").cast("string")
    day = F.date_add(F.lit("1990-01-01").cast("date"), (F.col("n") % 15_000).cast("int"))
    shapes = [
        w, w, title, F.upper("w"),
        F.concat(w, title, title), F.concat(title, F.upper(F.substring("w", 1, 2)), title),
        F.concat_ws("_", w, w, w), F.concat_ws("-", w, w, title), F.concat_ws("/", w, w), F.concat_ws("_", F.upper("w"), F.upper("w")),
        F.concat_ws("_", w, n), F.concat(w, F.substring(n, 1, 2)), F.concat_ws("=", w, F.concat(n, n, n)), F.concat_ws("-", title, F.substring(n, 1, 1), F.substring(n, 2, 1)),
        F.concat_ws("_", F.date_format(day, "yyyy-MM-dd"), w), F.concat_ws("-", w, F.date_format(day, "yyyyMMdd"), n), F.date_format(day, "yyyy/MM/dd"),
        F.concat_ws("-", n, n, n), F.concat(n, n, n, n),
    ]
    return words.select(F.explode(F.array(*shapes)).alias("token"))


def _code(text: Column) -> Column:
    return F.pmod(F.ascii(text), F.lit(SYMBOLS))


def pair_counts(tokens: DataFrame) -> dict[tuple[int, int], int]:
    """How often each character follows each other one."""
    chars = F.transform(F.split("token", ""), _code)
    chars = tokens.filter("length(token) > 0").select(chars.alias("c"))
    pairs = F.explode(F.arrays_zip(F.concat(F.array(F.lit(START)), F.slice("c", 1, F.size("c") - 1)).alias("a"), F.col("c").alias("b"))).alias("p")
    counts = chars.select(pairs).groupBy("p.a", "p.b").agg(F.count("*").alias("n"))
    return {(row["a"], row["b"]): row["n"] for row in counts.collect()}  # at most SYMBOLS * SYMBOLS rows


def _class(code: int) -> str:
    """The class of a character; what follows a separator begins anew."""
    c = chr(code)
    return "small" if c.islower() else "capital" if c.isupper() else "digit" if c.isdigit() else "start"


def log_probabilities(counts: dict[tuple[int, int], int]) -> list[list[float]]:
    """Log probabilities of each character after each other one: of its class after that class, and of its letter after that letter."""
    classes, letters = Counter(), Counter()
    after_class, after_letter = Counter(), Counter()

    def letter(code: int) -> str:
        return chr(code).lower() if _class(code) in ("small", "capital") else ""

    for (a, b), n in counts.items():
        if _class(b) == "start":
            continue
        classes[_class(a), _class(b)] += n
        after_class[_class(a)] += n
        if letter(b):
            letters[letter(a), letter(b)] += n
            after_letter[letter(a)] += n

    def step(a: int, b: int) -> float:
        if _class(b) == "start":  # separators speak for neither model
            return 0.0
        total = math.log((classes[_class(a), _class(b)] + 1) / (after_class[_class(a)] + 3))
        if letter(b):
            own = (letters[letter(a), letter(b)] + 1) / (after_letter[letter(a)] + 26)
            total += math.log((1 - ANY_LETTER) * own + ANY_LETTER / 26)
        return total

    return [[step(a, b) for b in range(SYMBOLS)] for a in range(SYMBOLS)]


def train(random: DataFrame, ordinary: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of characters, row by row."""
    yes, no = (log_probabilities(pair_counts(tokens)) for tokens in (random, ordinary))
    return [round(y - n, 4) for ys, ns in zip(yes, no, strict=True) for y, n in zip(ys, ns, strict=True)]


def model_array(model: list[float]) -> Column:
    """The model as one constant array."""
    return F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")


def ratio(token: Column, model: str | Column) -> Column:
    """Mean log-likelihood ratio a character of a token, by a column that holds the model."""
    model = F.col(model) if isinstance(model, str) else model
    codes = F.transform(F.split(token, ""), _code)
    step = F.aggregate(
        codes,
        F.struct(F.lit(START).alias("last"), F.lit(0.0).alias("sum")),
        lambda acc, c: F.struct(c.alias("last"), (acc["sum"] + F.element_at(model, acc["last"] * SYMBOLS + c + 1)).alias("sum")),
    )
    return step["sum"] / F.length(token)


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _edge(excess: Column, threshold: float) -> Column:
    """Characters before the place, next after a separator, where the sum so far is least and far enough below zero."""
    state = F.struct(F.lit(0).alias("at"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("low"), F.lit(0).alias("best"))

    def step(acc: Column, x: Column) -> Column:
        total = acc["sum"] + F.coalesce(x, F.lit(-threshold))
        lower = x.isNull() & (total <= acc["low"] - EDGE)
        return F.struct(
            (acc["at"] + 1).alias("at"),
            total.alias("sum"),
            F.when(lower, total).otherwise(acc["low"]).alias("low"),
            F.when(lower, acc["at"] + 1).otherwise(acc["best"]).alias("best"),
        )

    return F.aggregate(excess, state, step, lambda acc: acc["best"])


def stretches(token: Column, model: Column, threshold: float) -> Column:
    """Stretches (start, end) of a token: its windows of ``LEAST`` characters that beat the threshold, joined, without words at their edges."""
    apart = [ord(c) for c in SEPARATORS]
    codes = F.transform(F.split(token, ""), _code)

    def excesses(c: Column) -> Column:
        """What each character is beyond the threshold; null for separators."""
        before = F.concat(F.array(F.lit(START)), F.slice(c, 1, F.size(c) - 1))
        last = lambda a: F.when(a.isin(apart), F.lit(START)).otherwise(a)
        return F.zip_with(before, c, lambda a, b: F.when(~b.isin(apart), F.least(F.lit(CLIP), F.element_at(model, last(a) * SYMBOLS + b + 1)) - threshold))

    def windows(x: Column) -> Column:
        # The sum of a window gains its last character and loses the one before its first.
        values = F.transform(x, lambda e: F.coalesce(e, F.lit(-threshold)))
        change = _let(values, lambda v: F.zip_with(v, F.concat(F.array_repeat(F.lit(0.0), LEAST), F.slice(v, 1, F.size(v) - LEAST)), lambda new, old: new - old))
        state = F.struct(
            F.lit(0).alias("at"),
            F.lit(0.0).alias("sum"),
            F.lit(0).alias("start"),
            F.lit(0).alias("end"),
            F.array().cast("array<struct<start:int,end:int>>").alias("out"),
        )
        open_one = lambda acc: F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end")))

        def step(acc: Column, d: Column) -> Column:
            at, total = acc["at"] + 1, acc["sum"] + d
            hit = (at >= LEAST) & (total >= 0)
            new = hit & (at - LEAST > acc["end"]) | hit & (acc["end"] == 0)
            return F.struct(
                at.alias("at"),
                total.alias("sum"),
                F.when(new, at - LEAST).otherwise(acc["start"]).alias("start"),
                F.when(hit, at).otherwise(acc["end"]).alias("end"),
                F.when(new & (acc["end"] > 0), F.concat(acc["out"], open_one(acc))).otherwise(acc["out"]).alias("out"),
            )

        return F.aggregate(change, state, step, lambda acc: F.when(acc["end"] > 0, F.concat(acc["out"], open_one(acc))).otherwise(acc["out"]))

    def trimmed(x: Column, w: Column) -> Column:
        start = w["start"] + _edge(F.slice(x, w["start"] + 1, F.lit(LEAST)), threshold)
        end = w["end"] - _edge(F.reverse(F.slice(x, w["end"] - LEAST + 1, F.lit(LEAST))), threshold)
        cut = F.struct(start.alias("start"), end.alias("end"))
        return _let(cut, lambda s: F.when(s["start"] < s["end"], s).otherwise(w))

    return _let(_let(codes, excesses), lambda x: F.transform(windows(x), lambda w: trimmed(x, w)))


def likely(token: Column, model: Column, threshold: float) -> Column:
    """Spans of kind ``markov`` in a token (start, end, kind, match) of a text: the whole of it, or its stretches."""
    whole = F.array(F.struct(F.lit(0).alias("start"), F.length(token["match"]).alias("end")))
    found = F.when(ratio(token["match"], model) >= threshold, whole).otherwise(stretches(token["match"], model, threshold))
    return F.transform(
        found,
        lambda s: F.struct(
            (token["start"] + s["start"]).alias("start"),
            (token["start"] + s["end"]).alias("end"),
            F.lit(3).alias("kind"),
            token["match"].substr(s["start"] + 1, s["end"] - s["start"]).alias("match"),
        ),
    )


def blanked(text: Column, found: Column) -> Column:
    """A text with spaces in place of these ordered spans, so that places stay."""
    done = F.aggregate(
        found,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.concat(
                acc["out"],
                F.array(text.substr(acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))), F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(acc["at"], s["start"]), F.lit(0)))),
            ).alias("out"),
        ),
    )
    return _let(done, lambda d: F.concat(F.array_join(d["out"], ""), text.substr(d["at"] + 1, F.length(text))))


def spans(text: Column, pattern: str, kind: int, keep) -> Column:
    """Spans (start, end, kind, match) of a pattern's leftmost matches that do not overlap; ``keep`` tests a match.

    Matches and the gaps between them alternate, so a match starts where all gaps up to it and matches before it end.
    """
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    lengths = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda match, gap: F.struct(match.alias("match"), F.length(gap).alias("gap")))
    placed = F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,kind:int,match:string>>").alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.length(x["match"])).alias("at"),
            F.when(
                keep(x["match"]),
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + x["gap"]).alias("start"),
                            (acc["at"] + x["gap"] + F.length(x["match"])).alias("end"),
                            F.lit(kind).alias("kind"),
                            x["match"].alias("match"),
                        )
                    ),
                ),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
    )
    return placed["out"]


def _none() -> Column:
    return F.array().cast("array<struct<start:int,end:int,kind:int,match:string>>")


def _where(condition: Column, found: Column) -> Column:
    return F.when(condition, found).otherwise(_none())


def _free(df: DataFrame, name: str) -> str:
    """A name that no column of the table has."""
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return name


def with_spans(docs: DataFrame, model: list[float], text_col: str = "text", threshold: float = THRESHOLD, out: str = "spans") -> DataFrame:
    """The table with an array of spans (start, end, kind, match), ordered by start and kind."""
    base_name, tokens_name = _free(docs, "base"), _free(docs, "tokens")
    text = F.coalesce(F.col(text_col), F.lit(""))
    # The searches that decide whether a text needs positions at all.
    has_assign = text.rlike(ASSIGN)
    has_access = text.contains("AKIA") & text.rlike(f"AKIA[A-Z0-9]{{{LEAST_ACCESS - 4}}}")
    has_hex = text.rlike(f"[0-9a-f]{{{LEAST_HEX}}}")
    has_token = text.rlike(f"{TOKEN}{{{LEAST}}}")
    value = lambda match: F.regexp_extract(match, ASSIGN, 2)
    # The fixed forms.
    base = F.concat(
        _where(has_assign, spans(text, ASSIGN, 0, lambda m: F.length(value(m)) >= LEAST_ASSIGN)),
        _where(has_access, spans(text, ACCESS, 1, lambda m: F.length(m) >= LEAST_ACCESS)),
        _where(has_hex, spans(text, HEX_LONG, 2, lambda m: F.length(m) >= LEAST_HEX)),
    )
    judged = docs.withColumn(base_name, F.array_sort(base))
    left = F.when(F.size(base_name) > 0, blanked(text, F.col(base_name))).otherwise(text)
    plain = F.when(text.rlike(UUID), F.regexp_replace(left, UUID, " " * 36)).otherwise(left)  # a UUID has 36 characters, so places stay
    judged = judged.withColumn(tokens_name, _where(has_token, _let(plain, lambda t: spans(t, TOKEN_LONG, 3, lambda m: F.length(m) >= LEAST))))
    table = model_array(model)
    added = F.when(F.size(tokens_name) > 0, F.flatten(F.transform(tokens_name, lambda t: likely(t, table, threshold)))).otherwise(_none())
    return judged.withColumn(out, F.array_sort(F.concat(base_name, added))).drop(base_name, tokens_name)


def written(spans_col: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans_col, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def secret_scan(docs: DataFrame, model: list[float] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, number of spans of each fixed form, SHA-256 of these, and all spans."""
    model = model or train(random_strings(docs.sparkSession), identifiers(docs))
    found = with_spans(docs.select("doc_id", "text"), model, threshold=threshold, out="_spans")
    base = F.filter("_spans", lambda s: s["kind"] < 3)

    def number(kind: int) -> Column:
        return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select("doc_id", *map(number, range(4)), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("_spans")).alias("spans"))


def redacted(docs: DataFrame, model: list[float] | None = None, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The table with every span of its texts replaced by a mark; overlapping spans are replaced as one."""
    model = model or train(random_strings(docs.sparkSession), identifiers(docs, text_col))
    text, own = F.col(text_col), _free(docs, "spans")
    done = F.aggregate(
        own,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["out"])
            .otherwise(F.concat(acc["out"], F.array(text.substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))))
            .alias("out"),
        ),
    )
    clean = F.concat(F.array_join(done["out"], ""), text.substr(done["at"] + 1, F.length(text)))
    return with_spans(docs, model, text_col, out=own).withColumn(text_col, F.when(F.size(own) > 0, clean).otherwise(text)).drop(own)
