"""The codec over columns of payloads: Arrow batches around the kernel, one pass per payload.

Each function adds one struct column, so a payload is parsed once however many of
its fields are used.  Null payloads give null structs; nothing throws on bad JSON.
"""

from __future__ import annotations

import gzip
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructType

from ..functions.schemas import flat
from ..kernel import delta, lossy, questions, replies
from ..kernel.codec import LONG_TEXT, Codec, find_records, shape_of
from ..kernel.forms import minify, parse

_COUNTS = ("raw", "minified", "tabular", "compressed", "embedded")
_SAVED = ("minify", "tabularize", "dictionary", "embedded", "total")
MEASURED = flat("shape string, applicable boolean, roundtrip_ok boolean, embedded_ok boolean, " + ", ".join(f"{c}_tok long" for c in _COUNTS) + ", " + ", ".join(f"saved_{c} long" for c in _SAVED))


def _struct(function, kind: StructType):
    """A struct UDF of one or more string columns."""

    @F.pandas_udf(kind)
    def run(*columns: pd.Series) -> pd.DataFrame:
        rows = [function(*values) for values in zip(*columns)]
        return pd.DataFrame(rows, columns=kind.names)

    return run


def _text(function):
    @F.pandas_udf(StringType())
    def run(*columns: pd.Series) -> pd.Series:
        return pd.Series([function(*values) for values in zip(*columns)], dtype=object)

    return run


def shape(raw: Column) -> Column:
    return _text(lambda x: None if x is None else shape_of(x))(raw)


def measure(raw: Column, codec: Codec | None = None) -> Column:
    """Shape, gates, token counts and savings of every tier."""
    codec = codec or Codec()
    blank = dict.fromkeys(MEASURED.names)
    return _struct(lambda x: blank if x is None else codec.measure(x), MEASURED)(raw)


def emit(raw: Column, codec: Codec | None = None, **tiers: bool) -> Column:
    """(text, decision): verified text of the tiers."""
    codec = codec or Codec()
    kind = flat("text string, decision string")
    return _struct(lambda x: (None, None) if x is None else codec.emit(x, **tiers), kind)(raw)


def decode(text: Column, codec: Codec | None = None) -> Column:
    """The original value's compact JSON; text that is no JSON stays as it is."""
    codec = codec or Codec()

    def back(x):
        if x is None:
            return None
        try:
            return minify(codec.decompress(x))
        except (ValueError, KeyError, RecursionError):
            return x

    return _text(back)(text)


def join_blocks(blocks: Column, codec: Codec | None = None) -> Column:
    """(text, reason): an ordered array of blocks as one JSON array, or why not."""
    codec = codec or Codec()
    kind = flat("text string, reason string")
    return _struct(lambda x: codec.join_blocks(list(x)) if x is not None else (None, None), kind)(blocks)


def partial_joins(blocks: DataFrame, *keys: str, order: str, raw: str) -> DataFrame:
    """Maximal runs of two or more adjacent object blocks: (keys, run, first, blocks)."""
    from pyspark.sql import Window

    is_object = _flag(lambda x: x is not None and isinstance(parse(x)[1], dict))
    over = Window.partitionBy(*keys).orderBy(order)
    marked = blocks.withColumn("is_object", is_object(F.col(raw)))
    marked = marked.withColumn("run", F.sum(F.when(F.col("is_object"), 0).otherwise(1)).over(over)).where("is_object")
    runs = marked.groupBy(*keys, "run").agg(F.min(order).alias("first"), F.array_sort(F.collect_list(F.struct(order, raw))).alias("held"))
    return runs.where(F.size("held") >= 2).select(*keys, "run", "first", F.transform("held", lambda h: h[raw]).alias("blocks"))


def _flag(function):
    @F.pandas_udf(BooleanType())
    def run(*columns: pd.Series) -> pd.Series:
        return pd.Series([bool(function(*values)) for values in zip(*columns)])

    return run


def same_mirror(block: Column, structured: Column) -> Column:
    from ..kernel.codec import same_mirror as same

    return _flag(lambda a, b: a is not None and b is not None and same(a, b))(block, structured)


def row_delta(prev: Column, curr: Column, tool: Column, codec: Codec | None = None) -> Column:
    """(wire, back): the delta as sent, and what it gives back; nulls where none applies."""
    codec = codec or Codec()

    def run(a, b, name):
        (ok, x), (also, y) = parse(a), parse(b)
        if not (ok and also):
            return None, None
        text = delta.wire(x, y, codec.diff, name or "")
        return (text, minify(delta.apply(x, json.loads(text)))) if text else (None, None)

    return _struct(run, flat("wire string, back string"))(prev, curr, tool)


def text_delta(prev: Column, curr: Column) -> Column:
    """(ops, back): chunk operations as JSON, and the text they give back."""

    def run(a, b):
        ops, back = delta.text_both(a or "", b or "") if b is not None else (None, None)
        return (json.dumps(ops, ensure_ascii=False), back) if ops is not None else (None, None)

    return _struct(run, flat("ops string, back string"))(prev, curr)


def reduce_fields(raw: Column, tool: Column, fields: dict[str, dict], codec: Codec | None = None) -> Column:
    """(text, drops, gate): truncation and drops under their gates; the original where a gate fails."""
    codec = codec or Codec()
    kind = flat("text string, drops map<string;string>, gate boolean")

    def run(text, name):
        ok, value = parse(text)
        if not ok:
            if text is None:
                return None, None, None
            cut, store = lossy.drop_blocks(text, name or "", codec.dropped) if lossy.TEXT_BLOCKS in lossy.active(fields, "drop-to-retrieve") else (text, {})
            fine = lossy.restore_blocks(cut, codec.dropped, store) == text
            return (cut, store, True) if fine else (text, {}, False)
        try:
            short = lossy.truncate(value, fields)
            out, store = lossy.drop(short, fields, name or "", codec.dropped)
        except lossy.PathError:
            return text, {}, False
        fine = lossy.acceptable(value, short, fields) and lossy.recoverable(short, out, fields, codec.dropped, store)
        return (minify(out), {k: minify(v) for k, v in store.items()}, True) if fine else (text, {}, False)

    return _struct(run, kind)(raw, tool)


def gzip_ratio(raw: Column) -> Column:
    """Compressed against plain bytes, as a floor."""

    @F.pandas_udf("double")
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda t: len(gzip.compress(t.encode(), mtime=0)) / max(1, len(t.encode())) if t is not None else None)

    return run(raw)


@F.udtf(returnType="span_start int, span_end int")
class FencedSpans:
    """Spans of fenced blocks of a text."""

    def eval(self, text: str):
        for a, b in lossy.fences(text or ""):
            yield a, b


@F.udtf(returnType="row int, key string, value string, is_null boolean")
class Cells:
    """Cells of the first record list of a payload: bare strings as they are, all else compact JSON."""

    def eval(self, raw: str):
        ok, value = parse(raw)
        records = find_records(value)[0] if ok else None
        for i, record in enumerate(records or ()):
            for k, v in record.items():
                yield i, k, v if isinstance(v, str) else minify(v), v is None


@F.udtf(returnType="kind string, node string, n long")
class Candidates:
    """Repeated strings and subtrees of a payload in value position."""

    def eval(self, raw: str):
        ok, value = parse(raw)
        counts: dict[tuple[str, str], int] = {}
        work = [value] if ok else []
        while work:
            x = work.pop()
            if isinstance(x, (dict, list)):
                counts["j", minify(x)] = counts.get(("j", minify(x)), 0) + 1
                work += x.values() if isinstance(x, dict) else x
            elif isinstance(x, str):
                counts["s", x] = counts.get(("s", x), 0) + 1
        for (kind, node), n in counts.items():
            if n > 1:
                yield kind, node, n


@F.udtf(returnType="qid string, qtype string, transform string, prompt string, instruction string, expected string")
class Questions:
    """Questions on a payload; ``expected`` is JSON.  Text that is no JSON is asked about its lines."""

    def eval(self, raw: str):
        ok, value = parse(raw)
        made = questions.questions(value) if ok else questions.text_questions(raw or "")
        for q in made:
            yield q.qid, q.qtype, q.transform, q.prompt, q.instruction, minify(q.expected)


def score(qtype: Column, expected: Column, reply: Column) -> Column:
    return _flag(lambda q, e, r: r is not None and replies.score(q, json.loads(e), r))(qtype, expected, reply)


def ask(rows: DataFrame, answer, arms: tuple[str, ...], failed_is_miss: bool = False) -> DataFrame:
    """Put every question to an injected answerer, per arm: adds <arm>_ok and <arm>_trials.

    ``answer(arm, prompt, payload)`` returns a reply or None: a failed call, which leaves
    the denominator, or counts as a miss (as codec evaluations want it).
    """
    schema = StructType(list(rows.schema.fields)).simpleString()[7:-1]
    more = ", ".join(f"{a}_ok int, {a}_trials int" for a in arms)

    def run(batches):
        for pdf in batches:
            for arm in arms:
                given = [answer(arm, p, raw) for p, raw in zip(pdf["prompt"], pdf[arm])]
                pdf[f"{arm}_trials"] = [int(failed_is_miss or r is not None) for r in given]
                pdf[f"{arm}_ok"] = [int(r is not None and replies.score(q, json.loads(e), r)) for q, e, r in zip(pdf["qtype"], pdf["expected"], given)]
            yield pdf

    return rows.mapInPandas(run, f"{schema.replace(':', ' ')}, {more}")


def verify_summary(measured: DataFrame, column: str = "m") -> DataFrame:
    """Gates by shape; the embedded gate only where the main one passed."""
    m = lambda name: F.col(f"{column}.{name}")
    return measured.groupBy(m("shape").alias("shape")).agg(
        F.count(F.lit(1)).alias("payloads"), F.count_if(m("roundtrip_ok")).alias("lossless"), F.count_if(~m("roundtrip_ok")).alias("failures"),
        F.count_if(m("roundtrip_ok") & m("embedded_ok")).alias("embedded_ok"), F.count_if(m("roundtrip_ok") & ~m("embedded_ok")).alias("embedded_failures"),
        F.sum(m("raw_tok")).alias("raw_tok"), F.sum(m("saved_total")).alias("saved_tok"),
    )


def savings(measured: DataFrame, *keys: str, column: str = "m") -> DataFrame:
    """Savings per tier and in all, by rollup of the keys."""
    m = lambda name: F.col(f"{column}.{name}")
    rows = measured.rollup(*keys).agg(F.count(F.lit(1)).alias("payloads"), F.sum(m("raw_tok")).alias("raw_tok"), *(F.sum(m(f"saved_{t}")).alias(f"saved_{t}") for t in _SAVED))
    return rows.withColumn("saved_pct", F.try_divide(F.col("saved_total") * 100.0, F.col("raw_tok")))


def cross_counter(measured: DataFrame, a: str, b: str, *keys: str) -> DataFrame:
    """Savings under two token counters: largest and mean divergence; at most 3 points is invariant."""
    pct = lambda c: F.sum(F.col(f"{c}.saved_total")) * 100.0 / F.sum(F.col(f"{c}.raw_tok"))
    rows = measured.groupBy(*keys).agg(F.abs(pct(a) - pct(b)).alias("d"))
    return rows.agg(F.max("d").alias("max_divergence"), F.avg("d").alias("mean_divergence")).withColumn("invariant", F.col("max_divergence") <= 3.0)


def build_pack(payloads: DataFrame, codec: Codec | None = None) -> DataFrame:
    """(tool, sha, qid, qtype, transform, prompt, instruction, expected, raw, form): an evaluation to run elsewhere."""
    rows = payloads.select("tool", "sha", "raw", emit(F.col("raw"), codec)["text"].alias("form"))
    return rows.lateralJoin(Questions(F.col("raw").outer())).select("tool", "sha", "qid", "qtype", "transform", "prompt", "instruction", "expected", "raw", "form")


def score_pack(pack: DataFrame, responses: DataFrame) -> DataFrame:
    """Responses (model, [tool,] sha, qid, form, replies) against the pack's answers: right and trials per form.

    Replies to questions that the pack does not have go.  A response that names its tool meets
    that tool's payload only: payloads of two tools may be equal, or share a short hash.
    """
    kind = flat("ok int, trials int")

    def count(qtype, expected, given):
        return replies.score_form(qtype, json.loads(expected), list(given) if given is not None else [])

    keys = [c for c in ("tool", "sha", "qid") if c in responses.columns]
    asked = pack.select(*(F.col(c).alias(f"p_{c}") if c in keys else c for c in ("tool", "sha", "qid")), "qtype", "transform", "expected")
    # null-safe: a payload without a tool is one too
    met = responses.join(asked, [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in keys]).drop(*(f"p_{c}" for c in keys))
    scored = met.withColumn("s", _struct(count, kind)(F.col("qtype"), F.col("expected"), F.col("replies")))
    return scored.select("model", "tool", "sha", "qid", "qtype", "transform", "form", "s.ok", "s.trials")


def text_ceiling(raw: Column) -> Column:
    """(raw, line, phrase, block): tokens plain and with the aliases of each mode; how often each bound was met."""
    from ..kernel.textalias import ceiling

    kind = flat("raw long, line long, phrase long, block long, candidates_bound long, aliases_bound long, no_free_sigil long")
    return _struct(lambda x: dict.fromkeys(kind.names) if x is None else ceiling(x), kind)(raw)


def ask_dropped(rows: DataFrame, answer, fields: dict[str, dict], codec: Codec | None = None) -> DataFrame:
    """The two-turn protocol on dropped values, with an injected answerer.

    ``rows``: (id, tool, raw).  Turn one shows the reduced text and asks for a dropped value;
    ``answer(text, None)`` names a handle or None; turn two shows what the store holds for
    it, and ``answer(text, value)`` gives the reply.  Out: handle_ok, retrieve_ok, answer_ok, errors.
    """
    codec = codec or Codec()

    def run(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                ok, value = parse(row.raw)
                try:
                    small, store = lossy.drop(value, fields, row.tool, codec.dropped) if ok else (None, {})
                except lossy.PathError:
                    continue
                for name, original in store.items():
                    asked = answer(minify(small), None)
                    held = store.get(asked) if asked is not None else None
                    reply = answer(minify(small), held if isinstance(held, str) else minify(held)) if held is not None else None
                    truth = original if isinstance(original, str) else minify(original)
                    out.append((row.id, row.tool, int(asked == name), int(held is not None), int(reply == truth), int(asked is None)))
            yield pd.DataFrame(out, columns=["id", "tool", "handle_ok", "retrieve_ok", "answer_ok", "errors"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "tool", "raw").mapInPandas(run, f"id {kind}, tool string, handle_ok int, retrieve_ok int, answer_ok int, errors int")


def parse_events(body: Column) -> Column:
    """Data of server-sent events of a response body, in order: blank lines part events, data lines are joined."""
    blocks = F.filter(F.split(F.regexp_replace(body, "\r\n?", "\n"), "\n\n+"), lambda b: F.contains(b, F.lit("data:")))
    data = lambda b: F.array_join(F.transform(F.filter(F.split(b, "\n"), lambda x: F.startswith(x, F.lit("data:"))), lambda x: F.regexp_replace(x, "^data: ?", "")), "\n")
    return F.transform(blocks, data)


def text_drop_candidates(payloads: DataFrame, least: int = lossy.TEXT_DROP_MIN, share: float = 0.4) -> DataFrame:
    """Tools of two or more long texts whose large fenced blocks hold at least ``share`` of the tokens."""
    # one pass through Python: the shape is judged where the blocks are found, and shorter texts don't go there
    rows = payloads.where(F.length("raw") >= LONG_TEXT).select("tool", F.length("raw").alias("chars"), _long_blocks(F.col("raw")).alias("blocks"))
    held = F.aggregate("blocks", F.lit(0), lambda n, b: n + F.when(b >= least, F.floor(b / 4).cast("int")).otherwise(0))
    tokens = F.when(F.col("blocks").isNotNull(), F.floor(F.col("chars") / 4))
    rows = rows.select("tool", tokens.alias("t"), held.alias("held")).groupBy("tool").agg(F.count("t").alias("payloads"), F.sum("t").alias("tokens"), F.sum("held").alias("block_tokens"))
    return rows.where((F.col("payloads") >= 2) & (F.col("block_tokens") >= share * F.col("tokens")))


def blocks_of(text: Column) -> Column:
    """Lengths of the fenced blocks of a text."""

    @F.pandas_udf("array<int>")
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda t: [b - a for a, b in lossy.fences(t or "")])

    return run(text)


def _long_blocks(text: Column) -> Column:
    """The same of long texts that are no JSON, null of others."""

    @F.pandas_udf("array<int>")
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda t: [b - a for a, b in lossy.fences(t)] if t is not None and shape_of(t) == "long-text" else None)

    return run(text)
