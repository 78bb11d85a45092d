"""Secret scans: fixed patterns, and a randomness test battery over token-like strings.

All of it is DataFrame expressions. Of each long token its encoding is inferred; under the hypothesis that it is
random over that alphabet three tests give p-values: chi-squared for uniform use of the alphabet, the number of runs
above and below its middle, and the correlation of neighbours. Fisher's method joins them. A token is reported if it
looks random, where "random" starts at a threshold that holds the share of false reports: the prose of all documents,
cut into strings of each length, is scored alike, which gives the chance that a stretch of prose passes. In each class
of lengths and kind of alphabet the threshold is the lowest at which that chance, times the class's tokens, makes up
at most fdr of what passes. So one clearly random token passes on its own, however few others there are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.llm.text import let, stored

#: Fixed values of the base patterns: kind, expression, least length of the whole match, of group 2.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: What a text must contain for the expression beside it to have a match that is long enough.
BASE = (
    ("assign", ASSIGN, ASSIGN[:-2] + "{12,})", 0, 12),
    ("access", r"(AKIA)([A-Z0-9]+)", r"AKIA[A-Z0-9]{14}", 18, 0),
    ("hex", r"()([0-9a-f]+)", r"[0-9a-f]{16}", 16, 0),
)
TOKEN, LEAST = r"[A-Za-z0-9+/_=-]{20,}", 20
#: Stretches of a token that are tested: what stands between inner =, and in that the stretches of each smaller set.
STRETCHES = tuple(f"[A-Za-z0-9{signs}]+=*" for signs in ("+/_-", "+/", "_-", "+", ""))
#: Encodings in the order in which they are tried: expression of the whole token, alphabet.
LOW, CAP, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ENCODINGS = (
    (r"^[0-9]+$", DIGITS),
    (r"^[0-9a-f]+$", DIGITS + LOW[:6]),
    (r"^[0-9A-F]+$", DIGITS + CAP[:6]),
    (r"^[A-Z2-7]+=*$", CAP + DIGITS[2:8]),
    (r"^[a-z]+$", LOW),
    (r"^[a-z0-9]+$", DIGITS + LOW),
    (r"^[A-Z0-9]+$", DIGITS + CAP),
    (r"^[A-Za-z0-9]+$", DIGITS + CAP + LOW),
    (r"^[A-Za-z0-9+/]+=*$", DIGITS + CAP + LOW + "+/"),
    (r"^[A-Za-z0-9_-]+=*$", DIGITS + CAP + LOW + "-_"),
)
BINS = 9  # of the alphabet, for chi-squared with 8 degrees of freedom
GRID = 40  # steps of -log10 p, of a tenth
SETTLED = 1e-10
#: A p-value of chi-squared that makes the step GRID whatever the other tests give: the joint one is below 10^-4.4.
CLEAR = 3e-7
#: Kinds of alphabet, as prose looks far more random over its own letters: a-z, a-z with digits, all others.
KINDS = (r"^[a-z]+$", r"^[0-9]*[a-z][a-z0-9]*$")
#: Prose strings that a length needs, or else shorter ones stand for it, which look more random.
LEAST_STRINGS = 100
#: Prose that counts as one more document, for tables that have next to none.
PROSE = """The morning train left the station a little late and went slowly along the river. On the other bank some
people were already at work in the fields, and their dogs ran beside the water. Anna had taken a seat at the window
with her book, but she looked at the hills more often than at its pages. When the guard came by he asked whether she
was going as far as the coast. She said that her brother lived there, in one of the small houses behind the harbour,
and that she had not seen him since the winter before last. He would wait for her with the old car, which no longer
liked to start when the weather was wet. In the afternoon they would walk out to the lighthouse and count the ships,
just as they had done when both of them were children. The guard laughed and told her about his own family. They had
moved to the city many years ago, he explained, because nobody could find work in the village any more. Now his
daughter wanted to go back, grow apples and keep bees, and he did not know whether to be glad or sorry about that.
Outside the first drops of rain began to fall against the glass, and the lamps of the next town came into view."""


def blocks(items: Column, size: int = 128) -> Column:
    """An array in parts of size, in order. What grows by appending costs a part's square and not the array's."""
    cut = lambda x: F.transform(F.sequence(F.lit(0), F.ceil(F.size(x) / size).cast("int") - 1), lambda k: F.slice(x, k * size + 1, F.lit(size)))
    return let(items, lambda x: F.when(F.size(x) > 0, cut(x)).otherwise(F.slice(F.array(x), F.lit(1), F.lit(0))))


def spans(text: Column, expression: str, keep) -> Column:
    """Leftmost matches that do not overlap, as structs (start, end, match), end exclusive, in code points; keep gets
    the match and its group 2. What stands between matches and the matches themselves give the places, which are summed
    up for blocks of matches first."""
    gaps, whole, inner = F.split(text, expression, -1), F.regexp_extract_all(text, F.lit(expression), F.lit(0)), F.regexp_extract_all(text, F.lit(expression), F.lit(2 if "(" in expression else 0))
    parts = F.arrays_zip(gaps.alias("gap"), whole.alias("match"), inner.alias("inner"))
    begin = lambda at, kind: F.struct(at.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
    length = lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["match"]), F.lit(0))

    def add(so_far: Column, x: Column) -> Column:
        start, end = so_far["at"] + F.length(x["gap"]), so_far["at"] + length(x)
        new = F.array(F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match")))
        return F.struct(end.alias("at"), F.when(x["match"].isNotNull() & keep(x["match"], x["inner"]), F.concat(so_far["out"], new)).otherwise(so_far["out"]).alias("out"))

    def placed(cut: Column) -> Column:
        sizes = F.transform(cut, lambda b: F.aggregate(b, F.lit(0), lambda n, x: n + length(x)))
        before = F.aggregate(sizes, begin(F.lit(0), "int"), lambda x, n: F.struct((x["at"] + n).alias("at"), F.concat(x["out"], F.array(x["at"])).alias("out")))["out"]
        return F.flatten(F.zip_with(cut, before, lambda b, at: F.aggregate(b, begin(at, "struct<start:int,end:int,match:string>"), add)["out"]))

    return let(blocks(parts), placed)


def overlaps_none(sorted_spans: Column, body) -> Column:
    """body of a test whether a span (start, end) overlaps none of some spans, which are sorted by start. The test looks
    into those blocks of blocks only that reach it."""
    levels = 3

    def packed(items: Column, level: int) -> Column:
        if level == levels:
            return items
        first, last = ("start", "end") if level == 1 else ("low", "high")
        node = lambda b: F.struct(b[0][first].alias("low"), F.array_max(F.transform(b, lambda x: x[last])).alias("high"), b.alias("items"))
        return packed(F.transform(blocks(items, 64), node), level + 1)

    def met(items: Column, t: Column, level: int) -> Column:
        first, last = ("start", "end") if level == 1 else ("low", "high")
        deeper = lambda x: met(x["items"], t, level - 1) if level > 1 else F.lit(True)
        return F.exists(items, lambda x: (x[first] < t["end"]) & (t["start"] < x[last]) & deeper(x))

    return let(packed(sorted_spans, 1), lambda tree: body(lambda t: ~met(tree, t, levels)))


def normal_tail(x: Column, t: Column) -> Column:
    """P(|Z| > x * sqrt(2)) for x of 0 or more, to about 1e-7: the rational approximation of erfc; t is 1 / (1 + 0.3275911 * x)."""
    return F.greatest(t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * F.exp(-x * x), F.lit(1e-300))


def even_chi_tail(half: Column, df: int) -> Column:
    """P(chi-squared with an even number of degrees of freedom > 2 * half), exactly."""
    series = F.lit(1.0)
    for k in range(df // 2 - 1, 0, -1):
        series = 1 + half / k * series
    return F.when(half.isNotNull(), F.greatest(F.exp(-half) * series, F.lit(1e-300)))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def occurrences(text: Column, part: str) -> Column:
    """How often a part that doesn't overlap itself occurs in a text of ASCII."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("double")


def by_encoding(encoding: Column, value) -> Column:
    """value of the alphabet of an encoding, which is a place in ENCODINGS."""
    out = F.lit(None)
    for k, (_, letters) in enumerate(ENCODINGS):
        out = F.when(encoding == k, value(letters)).otherwise(out)
    return out


def recoded(text: Column, encoding: Column, sign) -> Column:
    """text with sign(place, size of the alphabet) for each letter. Plain string functions count such signs in a fraction of the
    time that arrays of letters take."""
    return by_encoding(encoding, lambda letters: F.translate(text, letters, "".join(sign(i, len(letters)) for i in range(len(letters)))))


def encoding_of(token: Column) -> Column:
    found = F.lit(None).cast("int")
    for k, (expression, _) in reversed(list(enumerate(ENCODINGS))):
        found = F.when(token.rlike(expression), k).otherwise(found)
    return found


def chi_squared(x) -> Column:
    """The statistic of uniform use of the alphabet, by BINS stretches of it that differ by one letter at most."""
    letters = lambda b: F.ceil((b + 1) * x("size") / BINS) - F.ceil(b * x("size") / BINS)
    return x("size") / x("n") * sum((x(f"seen{b}") * x(f"seen{b}") / letters(b) for b in range(1, BINS)), x("seen0") * x("seen0") / letters(0)) - x("n")


def battery(settled: float) -> list:
    """The three tests of a token and Fisher's p-value p, in steps: each gives new columns (name -> column) from those before,
    which x(name) gives. Steps can be columns of a table, which Spark compiles, or values within an array (randomness()).

    chi tests uniform use of the alphabet, runs the number of runs in its upper and lower half, serial the correlation
    of neighbours, from sums of places and of their products, which are whole numbers.
    """
    when_open = lambda x, value: F.when(x("chi") >= settled, value)
    places = lambda x: F.transform(F.split(recoded(x("text"), x("encoding"), lambda i, n: chr(48 + i)), ""), lambda c: (F.ascii(c) - 48).cast("double"))
    products = lambda at: F.zip_with(F.slice(at, F.lit(1), F.size(at) - 1), F.slice(at, F.lit(2), F.size(at) - 1), lambda a, b: a * b)
    log_p = lambda x, test: F.log(F.coalesce(normal_tail(x(f"x_{test}"), x(f"t_{test}")), F.lit(1e-9)))
    tested = lambda x, test: F.when(x(f"x_{test}").isNotNull(), log_p(x, test)).otherwise(math.log(1e-9))
    return [
        lambda x: {"encoding": encoding_of(x("token"))},
        lambda x: {"size": by_encoding(x("encoding"), lambda letters: F.lit(float(len(letters)))), "text": F.when(x("encoding").isNotNull(), F.rtrim(x("token"), F.lit("=")))},
        lambda x: {"bins": F.when(F.length(x("text")) >= 8, recoded(x("text"), x("encoding"), lambda i, n: str(i * BINS // n)))},
        lambda x: {"n": F.length(x("bins")).cast("double")} | {f"seen{b}": occurrences(x("bins"), str(b)) for b in range(BINS)},
        lambda x: {"half_chi": chi_squared(x) / 2},
        lambda x: {"chi": even_chi_tail(x("half_chi"), BINS - 1)},
        lambda x: {"high": when_open(x, recoded(x("text"), x("encoding"), lambda i, n: str(2 * i // n))), "at": when_open(x, places(x))},
        lambda x: {
            "ups": occurrences(x("high"), "1"), "runs": 1 + occurrences(x("high"), "01") + occurrences(x("high"), "10"),
            "s": total(x("at")), "squares": F.aggregate(x("at"), F.lit(0.0), lambda a, v: a + v * v), "products": total(products(x("at"))), "ends": x("at")[0] + F.element_at(x("at"), -1),
        },
        lambda x: {
            "due": 2 * x("ups") * (x("n") - x("ups")) / x("n") + 1,
            "variance": x("n") * x("squares") - x("s") * x("s"),
            "covariance": x("n") * x("products") - x("s") * (2 * x("s") - x("ends")) + x("s") * x("s") * (x("n") - 1) / x("n"),
        },
        lambda x: {
            "x_runs": F.when(x("due") > 2, F.abs(x("runs") - x("due")) / F.sqrt(2 * (x("due") - 1) * (x("due") - 2) / (x("n") - 1))),
            "x_serial": F.when(x("variance") > 0, F.abs(x("covariance") / x("variance") + 1 / x("n")) * F.sqrt(x("n") / 2)),
        },
        lambda x: {f"t_{test}": 1 / (1 + 0.3275911 * x(f"x_{test}")) for test in ("runs", "serial")},
        lambda x: {"half": -F.log(x("chi")) - F.when(x("chi") < settled, 0.0).otherwise(tested(x, "runs") + tested(x, "serial"))},
        lambda x: {"p": even_chi_tail(x("half"), 6)},
    ]


def randomness(token: Column, settled: float = SETTLED) -> Column:
    """Fisher's p-value of the three tests, for a token's inferred encoding; null where none fits. Where chi-squared alone
    is below settled the others count as 1, which leaves less than 1e-7 with SETTLED."""

    def after(steps: list, known: dict[str, Column]) -> Column:
        if not steps:
            return known["p"]
        made = steps[0](known.__getitem__)
        return let(F.struct(*[c.alias(name) for name, c in made.items()]), lambda x: after(steps[1:], known | {name: x[name] for name in made}))

    return let(F.struct(token.alias("token")), lambda x: after(battery(settled), {"token": x["token"]}))


def steps_of(tokens: DataFrame) -> DataFrame:
    """tokens (token, and columns that the battery doesn't name) with the column step, that of randomness(). Each step of the
    battery is a column, so Spark compiles it; within an array it takes some 70 microseconds a token, mostly for small structs."""
    out = tokens
    for made in battery(CLEAR):
        out = out.withColumns(made(F.col))
    return out.select(*tokens.columns, step(F.col("p")).alias("step"))


def step(p: Column) -> Column:
    """The grid step of a p-value: 0 is the most random, GRID the least."""
    return F.coalesce(F.least(F.floor(-F.log10(p) * 10), F.lit(GRID)), F.lit(GRID)).cast("int")


def candidates(token: Column) -> Column:
    """The distinct stretches of a token (start, end, match) that have LEAST or more characters, by STRETCHES."""
    long = [spans(token["match"], e, lambda whole, _: F.length(whole) >= LEAST) for e in STRETCHES]
    found = F.transform(F.concat(*long), lambda x: F.struct((token["start"] + x["start"]).alias("start"), (token["start"] + x["end"]).alias("end"), x["match"].alias("match")))
    return let(F.array_sort(found), lambda s: F.filter(s, lambda x, i: (i == 0) | (x != F.get(s, i - 1))))


def apart(found: Column) -> Column:
    """Of spans (start, end) that overlap only the longest, and of equally long ones the first."""
    by_length = F.array_sort(F.transform(found, lambda t: F.struct((t["start"] - t["end"]).alias("minus_length"), t["start"].alias("start"), t["end"].alias("end"))))
    none = F.array().cast("array<struct<minus_length:int,start:int,end:int>>")
    return F.aggregate(by_length, none, lambda kept, t: F.when(F.exists(kept, lambda k: (k["start"] < t["end"]) & (t["start"] < k["end"])), kept).otherwise(F.concat(kept, F.array(t))))


def length_class(n: Column) -> Column:
    """Half octaves."""
    return F.floor(F.log2(n) * 2).cast("int")


def kind_of(token: Column) -> Column:
    """The place in KINDS of the first that fits, or their number."""
    kind = F.lit(len(KINDS))
    for k, expression in reversed(list(enumerate(KINDS))):
        kind = F.when(token.rlike(expression), k).otherwise(kind)
    return kind


def evenly(text: Column, width: Column, most_apart: Column) -> Column:
    """A text of ASCII from its first letter to its last in as few stretches of a width as begin most_apart letters apart at most.
    They are cut from its bytes: a place in a string is found by counting from its start, so all of them in a text's square."""

    def cut(x: Column) -> Column:
        at = lambda i: F.floor(i.cast("long") * x["spare"] / F.greatest(x["parts"] - 1, F.lit(1))).cast("int") + 1
        return F.when(x["spare"] >= 0, F.transform(F.sequence(F.lit(0), x["parts"] - 1), lambda i: F.substring(x["raw"], at(i), width).cast("string")))

    spare = F.octet_length(text) - width
    return let(F.struct(text.cast("binary").alias("raw"), spare.alias("spare"), (F.ceil(spare / most_apart) + 1).cast("int").alias("parts")), cut)


def prose_strings(prose: DataFrame, widths: dict[int, int]) -> DataFrame:
    """prose (text: letters and digits only), cut whole: class, string. A text is cut into rounds, each a string of every width
    (class -> width) in turn as far as they fit into the text; rounds cover it, so every letter of every text counts."""
    sums = [sum(list(widths.values())[: k + 1]) for k in range(len(widths))]
    inside = F.size(F.filter(F.array(*map(F.lit, sums)), lambda n: n <= F.length("text")))
    rounds = prose.select("text", inside.alias("inside")).where("inside > 0").withColumn("n", F.element_at(F.array(*map(F.lit, sums)), F.col("inside")))
    rounds = rounds.select("inside", F.explode(evenly(F.col("text"), F.col("n"), F.col("n"))).alias("round"))
    strings = [F.struct(F.lit(c).alias("class"), F.substring("round", n - w + 1, w).alias("string")) for (c, w), n in zip(widths.items(), sums, strict=True)]
    return rounds.select(F.explode(F.slice(F.array(*strings), F.lit(1), F.col("inside"))).alias("x")).select("x.*")


def prose_chances(prose: DataFrame, classes: list[int]) -> dict[int, tuple[int, dict[tuple[int, int], int]]]:
    """For each class of lengths how many prose strings stand for it, and how many of them have each kind and step: those of
    prose_strings(), as long as the shortest of each class, and those of PROSE, which overlap by three quarters."""
    widths = {c: max(LEAST, math.ceil(2 ** (c / 2))) for c in range(math.floor(2 * math.log2(LEAST)), max(classes) + 1)}
    own = prose.sparkSession.range(1).select(F.regexp_replace(F.lit(PROSE), "[^A-Za-z0-9]+", "").alias("text"))
    cuts = F.array(*[F.struct(F.lit(c).alias("class"), evenly(F.col("text"), F.lit(w), F.lit(w // 4)).alias("strings")) for c, w in widths.items()])
    strings = prose_strings(prose, widths).unionAll(own.select(F.explode(cuts).alias("x")).select("x.class", F.explode("x.strings").alias("string")))
    scored = steps_of(strings.select("class", kind_of(F.col("string")).alias("kind"), F.col("string").alias("token")))
    counts = scored.groupBy("class", "kind", "step").count()
    seen: dict[int, dict[tuple[int, int], int]] = {c: {} for c in widths}
    for r in counts.collect():  # at most len(KINDS) + 1 times GRID + 1 rows for each class
        seen[r["class"]][r["kind"], r["step"]] = r["count"]
    there = {c: sum(x.values()) for c, x in seen.items()}
    stand_in = {c: max((k for k in widths if k <= c and there[k] >= LEAST_STRINGS), default=min(widths)) for c in classes}
    return {c: (there[k], seen[k]) for c, k in stand_in.items()}


def thresholds(tokens: DataFrame, prose: DataFrame, fdr: float) -> dict[tuple[int, int], int]:
    """The highest step that is reported for each class of lengths and kind of alphabet that has any.

    Were all tokens of a class stretches of prose, as many of them would pass as its prose strings say (one hit more
    counts, so few strings promise little); that may be fdr of what passes.
    """
    found = {(r["class"], r["kind"], r["step"]): r["count"] for r in tokens.groupBy("class", "kind", "step").count().collect()}  # as few rows
    if not found:
        return {}
    classes = sorted({c for c, _, _ in found})
    chances = prose_chances(prose, classes)
    limits = {}
    for c in classes:
        n_tokens, (n_strings, seen) = sum(n for (k, _, _), n in found.items() if k == c), chances[c]
        for kind in range(len(KINDS) + 1):
            passing = hits = 0
            for s in range(GRID):
                passing += found.get((c, kind, s), 0)
                hits += seen.get((kind, s), 0)
                if n_tokens * (hits + 1) <= fdr * passing * (n_strings + 1):
                    limits[c, kind] = s
    return limits


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = 0.05) -> DataFrame:
    """One row for each row of docs: id_col, spans: structs (start, end, kind) by start, then kind as in BASE and then
    "random"; start and end in code points, end exclusive.

    Base spans are the matches of BASE. A random span is a token of 20 or more characters, or a stretch of one as in
    STRETCHES, that passes the battery and overlaps no base span; of those that overlap the longest counts. So the
    value is tested in name=value, and a stretch in one encoding beside signs of another. Thresholds come from all
    tokens and all the prose of docs, and from PROSE. A null or empty text has no spans. Rows are independent; repeated
    rows, null ids stay.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def base(kind: str, expression: str, hint: str, least: int, least_inner: int) -> Column:
        return F.when(text.rlike(hint), spans(text, expression, lambda whole, inner: (F.length(whole) >= least) & (F.length(inner) >= least_inner))).otherwise(none).alias(kind)

    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), *[base(*x) for x in BASE], F.when(text.rlike(TOKEN), spans(text, TOKEN, lambda whole, _: F.lit(True))).otherwise(none).alias("token"))
    ranked = lambda rank: lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(rank).alias("rank"))
    bases = [F.transform(kind, ranked(k)) for k, (kind, *_) in enumerate(BASE)]
    rows = rows.withColumn("base", F.array_sort(F.concat(*bases)))
    scores = lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), length_class(F.length(t["match"])).alias("class"), kind_of(t["match"]).alias("kind"), step(randomness(t["match"])).alias("step"))
    scored = overlaps_none(F.col("base"), lambda free: F.transform("token", lambda token: F.transform(F.filter(candidates(token), free), scores)))
    bare = F.col("text")
    for expression in (TOKEN, *[hint for _, _, hint, _, _ in BASE]):
        bare = F.regexp_replace(bare, expression, "")
    prose = F.regexp_replace(F.when((F.size("token") > 0) | (F.size("base") > 0), bare).otherwise(F.col("text")), "[^A-Za-z0-9]+", "")
    rows = stored(rows.select("id", "base", scored.alias("tokens"), prose.alias("prose")), "secret-tokens")

    limits = thresholds(rows.select(F.explode(F.flatten("tokens")).alias("t")).select("t.*"), rows.select(F.col("prose").alias("text")), fdr)

    def passes(t: Column) -> Column:
        limit = F.lit(-1)
        for (size, kind), highest in limits.items():
            limit = F.when((t["class"] == size) & (t["kind"] == kind), highest).otherwise(limit)
        return t["step"] <= limit

    apart_in = lambda stretches: F.transform(apart(F.filter(stretches, passes)), ranked(len(BASE)))
    random = F.flatten(F.transform("tokens", apart_in))  # tokens don't overlap
    kinds = F.array(*[F.lit(k) for k, *_ in BASE], F.lit("random"))
    by_start = F.array_sort(F.transform(F.concat("base", random), lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end"))))
    return rows.select(F.col("id").alias(id_col), F.transform(by_start, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.get(kinds, x["rank"]).alias("kind"))).alias("spans"))


def joined(spans_col: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """Spans as kind:start:end, joined by commas; only those of the given kinds where some are."""
    chosen = F.filter(spans_col, lambda x: x["kind"].isin(*kinds)) if kinds else spans_col
    return F.array_join(F.transform(chosen, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
