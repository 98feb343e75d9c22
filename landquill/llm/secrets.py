"""Secret scans by pattern spans and character Markov models (operator 9)."""

from __future__ import annotations

import json
import math
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landquill.llm.common import checkpointed

#: Fixed patterns of the contract; group 1 is the value. Of an access key or a
#: hex run a part is never longer than the run from its start, so the least
#: length may stand in the pattern; a short assigned value uses up its text.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]{12,})"
HEX = r"((?<![0-9a-f])[0-9a-f]{32,})"
BASE = (("assign", ASSIGN, 8), ("access", ACCESS, 16), ("hex", HEX, 32))
#: What may be a secret or an ordinary identifier for the models.
TOKEN_LEAST = 12
TOKEN = rf"((?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{TOKEN_LEAST},}})"
SPANS = "array<struct<start:int,end:int,value:string>>"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
_START = 0
_SIZE = len(ALPHABET) + 1
#: Matches whose places are added up in one go.
_CHUNK = 128


def with_spans(df: DataFrame, text: str, patterns: dict[str, tuple[str, int, Column | None]]) -> DataFrame:
    """``df`` with, for each name of ``patterns`` (pattern, least length, gate), an array of struct(start, end, value) of the leftmost matches, left to right.

    What lies between matches and the matches themselves alternate, so places
    are running sums of their lengths in code points: within chunks of matches
    first, then over the chunks, since an accumulated array is copied at each
    step. Each step is a projection of its own, so that none is computed twice.
    The pattern's only capturing group is the value; matches with a shorter
    value are dropped after they have used up their text. Where the gate isn't
    true there are no matches.
    """
    columns, names = df.columns, list(patterns)
    gated = lambda k, x: x if patterns[k][2] is None else F.when(patterns[k][2], x)
    cut = {f"_gaps_{k}": gated(k, F.split(F.col(text), patterns[k][0], -1)) for k in names} | {f"_hits_{k}": gated(k, F.regexp_extract_all(text, F.lit(patterns[k][0]), F.lit(0))) for k in names}
    df = df.withColumns(cut | {f"_values_{k}": gated(k, F.regexp_extract_all(text, F.lit(patterns[k][0]), F.lit(1))) for k in names if not _whole(patterns[k][0])})

    def pieces(k: str) -> Column:
        values = F.col(f"_hits_{k}" if _whole(patterns[k][0]) else f"_values_{k}")
        return F.zip_with(F.arrays_zip(F.col(f"_hits_{k}").alias("hit"), values.alias("value")), F.slice(F.col(f"_gaps_{k}"), F.lit(1), F.size(f"_hits_{k}")), lambda h, g: F.struct(F.length(g).alias("gap"), F.length(h["hit"]).alias("n"), h["value"].alias("value")))

    def within(chunk: Column, least: int) -> Column:
        def step(state: Column, x: Column) -> Column:
            start = state["at"] + x["gap"]
            end = start + x["n"]
            found = F.concat(state["found"], F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))))
            return F.struct(end.alias("at"), F.when(F.length(x["value"]) >= least, found).otherwise(state["found"]).alias("found"))

        return F.aggregate(chunk, F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("found")), step)

    def chunks(k: str) -> Column:
        own = F.col(f"_pieces_{k}")
        return F.when(F.size(own) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / _CHUNK).cast("int")), lambda i: within(F.slice(own, i * _CHUNK + 1, F.lit(_CHUNK)), patterns[k][1])))

    df = df.withColumns({f"_pieces_{k}": pieces(k) for k in names}).withColumns({f"_chunks_{k}": chunks(k) for k in names})
    df = df.withColumns({f"_starts_{k}": F.aggregate(f"_chunks_{k}", F.array(F.lit(0)), lambda s, c: F.concat(s, F.array(F.element_at(s, -1) + c["at"]))) for k in names})
    moved = lambda k: F.zip_with(f"_chunks_{k}", F.slice(f"_starts_{k}", F.lit(1), F.size(f"_chunks_{k}")), lambda c, at: F.transform(c["found"], lambda x: F.struct((x["start"] + at).alias("start"), (x["end"] + at).alias("end"), x["value"].alias("value"))))
    return df.select(*columns, *[F.coalesce(F.flatten(moved(k)), F.array().cast(SPANS)).alias(k) for k in names])


def _whole(pattern: str) -> bool:
    """Whether the value is all of the match."""
    return pattern.startswith("(") and pattern.endswith(")") and pattern != ASSIGN


def _spans_of(rank: int, kind: str) -> Callable[[Column], Column]:
    return lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value"))


def _codes(token: Column) -> Column:
    """The token's characters as places in the alphabet, 1 up; 0 for any other."""
    return F.transform(F.sequence(F.lit(1), F.length(token)), lambda i: F.instr(F.lit(ALPHABET), F.substring(token, i, F.lit(1))))


def _bigrams(token: Column) -> Column:
    """Cells from * _SIZE + to of all steps of the token, the first from the start."""
    codes = _codes(token)
    before = F.concat(F.array(F.lit(_START)), F.slice(codes, 1, F.size(codes) - 1))
    return F.zip_with(before, codes, lambda a, b: a * _SIZE + b)


def markov_model(samples: DataFrame, smooth: float = 0.5) -> tuple[list[float], float] | None:
    """(log-likelihood ratio, random over ordinary, of every character step; log of the prior odds). None without samples of both labels.

    samples: token, random (boolean). All samples are counted; the result has
    one cell for each pair of characters of the alphabet, whatever the corpus.
    The token that is judged may be one of the ordinary samples, so that one
    occurrence of each of their steps doesn't count.
    """
    cells = samples.select("random", F.explode(_bigrams(F.col("token"))).alias("cell")).groupBy("random", "cell").agg(F.count(F.lit(1)).alias("n")).collect()
    count: dict[bool, dict[int, int]] = {True: defaultdict(int), False: defaultdict(int)}
    for r in cells:
        count[r["random"]][r["cell"]] += r["n"]
    n = {k: sum(v for cell, v in c.items() if cell < _SIZE) for k, c in count.items()}  # tokens: steps from the start
    if not all(n.values()):
        return None
    table = [0.0] * (_SIZE * _SIZE)
    for a in range(_SIZE):
        row = {k: sum(count[k][a * _SIZE + b] for b in range(_SIZE)) for k in count}
        for b in range(_SIZE):
            random = (count[True][a * _SIZE + b] + smooth) / (row[True] + smooth * _SIZE)
            ordinary = (max(0, count[False][a * _SIZE + b] - 1) + smooth) / (max(0, row[False] - 1) + smooth * _SIZE)
            table[a * _SIZE + b] = math.log(random / ordinary)
    return table, math.log(n[True] / n[False])


def log_odds(token: Column, model: tuple[list[float], float]) -> Column:
    """Log of the odds that a token is random: its steps' ratios and the prior odds added up."""
    cells = F.from_json(F.lit(json.dumps(model[0])), "array<double>")
    return F.aggregate(_bigrams(token), F.lit(model[1]), lambda s, cell: s + F.element_at(cells, cell + 1))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.0) -> DataFrame:
    """Spans of secrets in every text: id, base and found (arrays of struct(start, rank, end, kind, value)).

    kind is assign, access or hex for the spans of the fixed patterns, and
    markov for a token (letters, digits and +/_=-) of TOKEN_LEAST or more
    characters that overlaps none of the others and whose odds of being random
    rather than an ordinary identifier are over ``threshold`` as a logarithm.
    The odds come from two first-order chains over characters and from how
    many samples each has. The samples are those of all texts, each different
    token once: the values of pattern spans are labelled random, the tokens
    outside such spans ordinary; what secrets are among the latter are too few
    to change their counts. Without samples of both labels no markov span is
    found. Positions are code points, end exclusive. Null texts count as empty
    and have no spans; repeated rows are each scanned.
    """
    body = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    gates = {"assign": F.rlike("_t", F.lit(ASSIGN)), "access": F.contains("_t", F.lit("AKIA")), "hex": F.rlike("_t", F.lit(HEX))}
    placed = with_spans(body, "_t", {k: (p, n, gates[k]) for k, p, n in BASE} | {"long": (TOKEN, TOKEN_LEAST, None)})
    scanned = checkpointed(placed.drop("_t"))
    base = F.concat(*[F.transform(k, _spans_of(rank, k)) for rank, (k, _, _) in enumerate(BASE)])
    marked = scanned.select("doc_id", F.array_sort(base).alias("base"), "long")
    # Few texts have any base span, and only there can a token overlap one.
    free = F.when(F.size("base") == 0, F.col("long")).otherwise(F.filter("long", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))))
    marked = marked.withColumn("free", free)
    secret = marked.select(F.explode("base").alias("b")).select(F.col("b.value").alias("token"), F.lit(True).alias("random"))
    plain = marked.select(F.explode("free").alias("t")).select(F.col("t.value").alias("token"), F.lit(False).alias("random"))
    model = markov_model(secret.union(plain).distinct())
    scored = F.filter("free", lambda t: log_odds(t["value"], model) > threshold) if model else F.array().cast(SPANS)
    extra = F.transform(scored, _spans_of(len(BASE), "markov"))
    return marked.select(F.col("doc_id").alias(id_col), "base", F.array_sort(F.concat("base", extra)).alias("found"))


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.0) -> DataFrame:
    """id, n_assign, n_access, n_hex, n_markov, base_sha256, spans of every text.

    Null and empty texts have no span; repeated rows are each reported. Other columns, whatever their names, play no part; an empty table gives an empty one.
    A text of any length stays one value of one row.
    """
    found = secret_spans(docs, id_col, text_col, threshold)
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda column: F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(id_col, count("assign"), count("access"), count("hex"), F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("found").alias("spans"), count("markov"))
