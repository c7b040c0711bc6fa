"""Personal data spans: strict patterns, and a classifier taught by weak labelers.

Base spans are the matches of strict patterns that pass a check (number ranges, Luhn, digits).
Wider patterns propose further spans, such as spelled-out addresses, telephone numbers without a
country code, long network addresses or card numbers that fail the check. Labelers vote on every
candidate (yes, no, or no opinion): the strict pattern, the inner structure, a gazetteer of
endings, prefixes and issuers, words that announce such data on the left, and words that announce
something else. Expectation-maximisation over the counts of vote patterns estimates how often each
labeler is right for each kind, without any labels, and gives every vote pattern a probability. A
logistic classifier over votes, kind and length is fitted to these probabilities and decides which
candidates are added. Base spans always stay, and nothing is added that overlaps one.

All work on documents is built-in Spark functions on arrays of spans: one pass without a shuffle,
and an aggregation of vote patterns, of which there are at most a few thousand whatever the input;
only these counts come to the driver.

Defined results: a null text is empty and has no spans. Null ids are kept, repeated rows are
handled each for itself, an empty table gives no rows, other columns ride along untouched. Spans
count code points, with an exclusive end.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm.groups import stored

KINDS = ["email", "ip", "card", "phone"]

# The strict patterns. Possessive quantifiers and the tests on the left give the same matches as
# [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ , [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+) ,
# [0-9]([\x20-]?[0-9])+ of two digits or more, and \+[0-9][\x20().0-9-]+[0-9], in linear time.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\]|@|\x20at\x20)\x20?[A-Za-z0-9-]++(?:\x20?(?:\(dot\)|\[dot\]|\.|\x20dot\x20)\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9-])[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{3,4}(?![0-9-])",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
}
# A text without these can't match.
NEEDS = {"email": r"@|\bat\b", "ip": r"[0-9][.:]", "card": r"[0-9]", "phone": r"[0-9]"}
NEEDS_STRICT = {"email": "@", "ip": ".", "card": None, "phone": "+"}

_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"

# What the gazetteer and the context labelers know.
ENDINGS = "com net org edu gov io info biz de fr es it uk eu us ca au ch at nl be pl ru jp cn in br mx".split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
YES_WORDS = {
    "email": "mail email e-mail contact write correo courriel kontakt",
    "ip": "ip host server address adresse dirección login",
    "card": "card visa mastercard amex karte tarjeta carte payment",
    "phone": "tel phone call fax mobile cell telefon handy teléfono téléphone rufen llamar appeler",
}
NO_WORDS = "version release isbn issn invoice order section chapter serial model figure table build".split()

LABELERS = ["pattern", "structure", "gazetteer", "announced", "other"]
_LENGTHS = [10, 14, 18, 24]
_SPAN = "struct<start:int,end:int,text:string>"

# Code points of a block of text, and values of a block of running sums.
BLOCK = 256


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often lambdas in the body use it."""
    return F.transform(F.array(value), body)[0]


def running(values: Column) -> Column:
    """The sum of each long and all before it.

    A fold that appends to an array copies it at every step, so the steps stay within blocks of
    ``BLOCK`` values; the blocks' own sums are added in a second, short fold.
    """
    none = F.array().cast("array<bigint>")

    def append(state: Column, x: Column, shown: Column) -> Column:
        at = state["at"] + x
        return F.struct(at.alias("at"), F.concat(state["out"], F.array(shown)).alias("out"))

    def sums(block: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))
        return F.aggregate(block, start, lambda s, x: append(s, x, s["at"] + x))["out"]

    def joined(blocks: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))
        before = F.aggregate(blocks, start, lambda s, block: append(s, F.element_at(block, -1), s["at"]))["out"]
        return F.flatten(F.zip_with(blocks, before, lambda block, n: F.transform(block, lambda x: x + n)))

    def blocks(own: Column) -> Column:
        at = F.sequence(F.lit(0), F.floor((F.size(own) - 1) / BLOCK).cast("int"))
        return F.transform(at, lambda i: sums(F.slice(own, i * BLOCK + 1, F.lit(BLOCK))))

    return let(values, lambda own: F.when(F.size(own) == 0, none).otherwise(let(blocks(own), joined)))


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches with their places in code points.

    The texts between the matches come from splitting by the same pattern; running sums of the
    lengths give the places.
    """
    def spans(found: Column) -> Column:
        # the last text between matches has no match after it
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        ends = running(F.zip_with(gaps, found, lambda gap, m: (F.length(gap) + F.length(m)).cast("long")))
        return F.zip_with(
            found, ends,
            lambda m, e: F.struct((e - F.length(m)).cast("int").alias("start"), e.cast("int").alias("end"), m.alias("text")),
        )

    return let(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(0)), spans)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """True where the digits pass the Luhn check."""
    own = F.reverse(digits(text))
    values = F.transform(F.filter(F.split(own, ""), lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(2 * c.cast("int")))
    total = F.aggregate(values, F.lit(0), lambda s, v: s + F.when(v > 9, v - 9).otherwise(v))
    return total % 10 == 0


def valid(kind: str, text: Column) -> Column:
    """Whether a match of the strict pattern counts."""
    if kind == "ip":
        return text.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.length(digits(text)).between(16, 19) & luhn(text)
    if kind == "phone":
        return F.length(digits(text)).between(8, 15)
    return F.lit(True)


def _before(blocks: Column, start: Column) -> Column:
    """The 30 code points before a place, from a text in blocks of ``BLOCK``: a substring of the
    whole text would walk there from its beginning."""
    at = F.floor(start / BLOCK).cast("int")
    last = F.coalesce(F.get(blocks, at - 1), F.lit(""))
    return F.right(F.concat(last, F.left(F.get(blocks, at), start % BLOCK)), F.lit(30))


def _votes(kind: str, blocks: Column, span: Column, strict: Column) -> Column:
    """The labelers' votes on a span: 1 yes, 0 no, -1 no opinion."""
    body = span["text"]
    before = F.lower(_before(blocks, span["start"]))
    words = "|".join(YES_WORDS[kind].split())
    count = F.length(digits(body))
    yes, no, none = F.lit(1), F.lit(0), F.lit(-1)
    structure = {
        "email": F.when(body.rlike(r"[A-Za-z]{2,}$") & body.rlike(r"^[A-Za-z0-9]"), yes).otherwise(no),
        "ip": F.when(body.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$") | body.contains(":"), yes).otherwise(no),
        "card": F.when(luhn(body), yes).otherwise(no),
        "phone": F.when(count.between(8, 15), yes).otherwise(no),
    }[kind]
    gazetteer = {
        "email": F.when(F.lower(F.regexp_extract(body, r"([A-Za-z0-9-]+)$", 1)).isin(ENDINGS), yes).otherwise(none),
        "ip": F.when(body.rlike(r"^(?:0|255)\."), no).when(body.rlike(r"^(?:10|127|172|192)\."), yes).otherwise(none),
        "card": F.when(digits(body).rlike(ISSUERS), yes).otherwise(no),
        "phone": F.when(body.rlike(r"^(?:\+|00)[1-9]"), yes).otherwise(none),
    }[kind]
    return F.array(
        F.when(strict, yes).otherwise(none),
        structure,
        gazetteer,
        F.when(before.rlike(rf"(?:^|[^\p{{L}}])(?:{words})[^\p{{L}}]{{0,8}}$"), yes).otherwise(none),
        F.when(before.rlike(rf"(?:^|[^\p{{L}}])(?:{'|'.join(NO_WORDS)})[^\p{{L}}]{{0,8}}$"), no).otherwise(none),
    )


def _length_class(span: Column) -> Column:
    size = span["end"] - span["start"]
    return sum(F.when(size >= n, 1).otherwise(0) for n in _LENGTHS)


def _is_valid(kind: str):
    return lambda s: valid(kind, s["text"])


# Places of spans' ends as longs, four times the code point plus one of these: the order in which
# ends at one place count.
_SPAN_END, _TAKEN_END, _SPAN_START, _TAKEN_START = range(4)


def free(spans: Column, taken: Column) -> Column:
    """The spans, in order and without overlap among them, that no taken span overlaps.

    A span overlaps one where more taken spans start before its end than end before its start. Both
    numbers come from running sums over all sorted ends, so the work does not grow with the product.
    """
    def ends(of: Column, start: int, end: int) -> Column:
        place = lambda name, order: F.transform(of, lambda x: x[name].cast("long") * 4 + order)
        return F.concat(place("start", start), place("end", end))

    def counted(ordered: Column) -> Column:
        counts = F.transform(
            ordered,
            lambda e: F.when(e % 4 == _TAKEN_START, F.lit(1).cast("long")).when(e % 4 == _TAKEN_END, F.lit(1 << 32)).otherwise(F.lit(0).cast("long")),
        )
        return F.zip_with(ordered, running(counts), lambda e, n: F.struct((e % 4).alias("order"), n.alias("n")))

    def kept(own: Column, seen: Column) -> Column:
        at_start = F.filter(seen, lambda c: c["order"] == _SPAN_START)
        at_end = F.filter(seen, lambda c: c["order"] == _SPAN_END)
        overlaps = F.zip_with(at_start, at_end, lambda s, e: F.shiftright(s["n"], 32) < e["n"] % (1 << 32))
        pairs = F.zip_with(own, overlaps, lambda span, o: F.struct(span.alias("span"), o.alias("o")))
        return F.transform(F.filter(pairs, lambda p: ~p["o"]), lambda p: p["span"])

    def tested(own: Column) -> Column:
        ordered = F.array_sort(F.concat(ends(own, _SPAN_START, _SPAN_END), ends(taken, _TAKEN_START, _TAKEN_END)))
        return let(let(ordered, counted), lambda seen: kept(own, seen))

    return let(spans, lambda own: F.when((F.size(own) == 0) | (F.size(taken) == 0), own).otherwise(tested(own)))


def _place(span: Column) -> Column:
    return F.struct(span["start"].alias("start"), span["end"].alias("end"))


def _voted(kind: str, blocks: Column, base: bool):
    return lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(base).alias("base"),
        _votes(kind, blocks, s, F.lit(base)).alias("votes"), _length_class(s).alias("size"),
    )


def _all_voted(kind: str):
    parts = ((f"base_{kind}", True), (f"wide_{kind}", False))
    return lambda blocks: F.concat(*[F.transform(spans, _voted(kind, blocks, base)) for spans, base in parts])


def candidates(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The ``columns`` of each row of ``docs`` (all by default) as struct ``row``; the base spans of
    each kind, and of each kind the candidates (start, end, base, votes, length class)."""
    columns = docs.columns if columns is None else columns
    out = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in columns]).alias("row"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")
    )
    none = F.array().cast(f"array<{_SPAN}>")
    text = F.col("text")
    out = out.withColumn("digit", text.rlike("[0-9]"))
    for kind in KINDS:
        may = F.col("digit") if kind != "email" else F.lit(True)
        if NEEDS_STRICT[kind]:
            may = may & text.contains(NEEDS_STRICT[kind])
        out = out.withColumn(f"base_{kind}", F.when(may, F.filter(matches(text, STRICT[kind]), _is_valid(kind))).otherwise(none))
    bases = [f"base_{k}" for k in KINDS]
    out = out.withColumn("taken", F.concat(*bases))
    for kind in KINDS:
        may = F.col("digit") if kind != "email" else text.rlike(NEEDS["email"])
        out = out.withColumn(f"wide_{kind}", F.when(may, free(matches(text, WIDE[kind]), F.col("taken"))).otherwise(none))
    some = sum((F.size(f"wide_{k}") for k in KINDS), F.size("taken")) > 0
    cut = F.when(some, F.regexp_extract_all(text, F.lit(f"((?s).{{1,{BLOCK}}})"), F.lit(0)))
    out = out.withColumn("blocks", cut)
    for kind in KINDS:
        out = out.withColumn(f"cand_{kind}", let(F.col("blocks"), _all_voted(kind)))
    places = [F.transform(f"base_{k}", _place).alias(f"base_{k}") for k in KINDS]
    return out.select("row", *places, *[f"cand_{k}" for k in KINDS])


def reliabilities(votes: np.ndarray, counts: np.ndarray, steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns (patterns x labelers, -1, 0, 1) with counts.

    Gives each pattern's probability of yes, and P(vote | truth) as (labeler, truth, vote). No
    opinion says nothing; labelers are taken to be right more often than not to begin with.
    """
    cast = np.stack([votes == v for v in (0, 1)], axis=2).astype(float)
    posterior = ((votes == 1).sum(1) + 0.5) / ((votes >= 0).sum(1) + 1)
    table = np.zeros((votes.shape[1], 2, 2))
    for _ in range(steps):
        table = np.stack([np.einsum("plv,p->lv", cast, counts * w) for w in (1 - posterior, posterior)], axis=1)
        table += np.array([[2.0, 1.0], [1.0, 2.0]])
        table /= table.sum(2, keepdims=True)
        prior = (counts @ posterior + 1) / (counts.sum() + 2)
        likelihood = np.exp(np.einsum("plv,ltv->pt", cast, np.log(table)))
        yes, no = prior * likelihood[:, 1], (1 - prior) * likelihood[:, 0]
        posterior = yes / (yes + no)
    return posterior, table


def teach(found: DataFrame) -> dict[str, list[float]]:
    """The final classifier's weights: for each labeler by vote (no opinion, no, yes), for kinds
    and length classes, and the intercept."""
    def seen(kind: int):
        return lambda c: F.struct(F.lit(kind).alias("kind"), c["votes"].alias("votes"), c["size"].alias("size"))

    every = F.concat(*[F.transform(f"cand_{k}", seen(i)) for i, k in enumerate(KINDS)])
    patterns = found.select(F.explode(every).alias("c")).groupBy("c.kind", "c.votes", "c.size").agg(F.count("*").alias("n")).collect()
    width = 3 * len(LABELERS) + len(KINDS) + len(_LENGTHS) + 1
    x, target, weight = np.zeros((len(patterns), width)), np.zeros(len(patterns)), np.zeros(len(patterns))
    for kind in range(len(KINDS)):
        at = [i for i, p in enumerate(patterns) if p["kind"] == kind]
        if at:
            target[at], _ = reliabilities(np.array([patterns[i]["votes"] for i in at]), np.array([patterns[i]["n"] for i in at], float))
    for i, p in enumerate(patterns):
        for k, v in enumerate(p["votes"]):
            x[i, 3 * k + v + 1] = v >= 0
        x[i, 3 * len(LABELERS) + p["kind"]] = 1
        x[i, 3 * len(LABELERS) + len(KINDS) + p["size"]] = 1
        weight[i] = np.sqrt(p["n"])
    w, b, total = np.zeros(width), 0.0, max(weight.sum(), 1.0)
    for _ in range(400):
        error = weight * (1 / (1 + np.exp(-(x @ w + b))) - target) / total
        w, b = w - 2.0 * (x.T @ error + 1e-3 * w), b - 2.0 * error.sum()
    flat = w.tolist()
    return {
        "votes": flat[: 3 * len(LABELERS)],
        "kinds": flat[3 * len(LABELERS) : 3 * len(LABELERS) + len(KINDS)],
        "sizes": flat[3 * len(LABELERS) + len(KINDS) :],
        "intercept": [float(b)],
    }


def _added(fixed: Column, votes: Column, sizes: Column):
    """True for candidates beyond the base that the classifier takes."""

    def test(c: Column) -> Column:
        own = sum((F.get(votes, c["votes"][k] + 1 + 3 * k) for k in range(len(LABELERS))), fixed)
        return ~c["base"] & (own + F.get(sizes, c["size"]) > 0)

    return test


def find_spans(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The ``columns`` of each row of ``docs`` (all by default) as struct ``row``, with base and all
    spans of each kind as arrays of (start, end), in order. Only these columns are written aside."""
    found = stored(docs.sparkSession, candidates(docs, columns), "candidates")
    model = teach(found)
    votes = F.array(*[F.lit(v) for v in model["votes"]])
    sizes = F.array(*[F.lit(v) for v in model["sizes"]])
    out = found
    for i, kind in enumerate(KINDS):
        fixed = F.lit(model["intercept"][0] + model["kinds"][i])

        extra = F.transform(F.filter(f"cand_{kind}", _added(fixed, votes, sizes)), _place)
        out = out.withColumn(f"all_{kind}", F.array_sort(F.concat(f"base_{kind}", extra)))
    return out.select("row", *[f"base_{k}" for k in KINDS], *[f"all_{k}" for k in KINDS])


def listed(prefix: str) -> Column:
    """kind:start:end of all kinds, comma-joined."""
    def text(kind: str):
        return lambda s: F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))

    texts = [F.transform(f"{prefix}_{k}", text(k)) for k in KINDS]
    return F.array_join(F.concat(*texts), ",")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_spans(docs, ["doc_id"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed("all").alias("spans"),
    )
