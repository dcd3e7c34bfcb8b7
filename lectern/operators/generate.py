"""Sampling and generation over the count model.

Per context, the candidate list is bounded by ``top_k`` before anything else is
computed, so a context followed by millions of distinct tokens is never one
window partition: up to Spark's group-limit threshold the ``row_number() <= k``
filter is planned as a partial limit on the map side; for larger ``k`` each
context is first cut into slices by token hash that are ranked on their own.

Order of the warpers follows the reference's generation call: temperature,
then top-k, then top-p, then a draw. Every draw is ``md5(seed:prompt:seq:step)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import uniform01
from ..session import cut_lineage
from .joins import BROADCAST_MAX_CELLS, head_and_tail, lookup, string_cells
from .lm import BigramModel

BACKOFF = ""   # context key of the unigram (back-off) distribution
WALK_BYTES = 256 << 20   # candidate tables up to this size are broadcast whole

# ---------------------------------------------------------------------------
# The generated-text file's labels.
PROMPT_LINE = "Prompt: %s\n"
SAMPLE_HEADER = "Generated Text %d:\n%s\n\n"
# ---------------------------------------------------------------------------


def next_token_probs(model: BigramModel) -> DataFrame:
    """``prev, tok, p``: maximum-likelihood successor distribution of each seen
    context, plus the unigram distribution under context ``''``."""
    seen = lookup(model.bigram, model.context, ["prev"], "inner", small_size=model.context_size,
                  count_col="c_prev").select(
        "prev", "tok", (F.col("c") / F.col("c_prev")).alias("p"))
    uni = model.unigram.select(F.lit(BACKOFF).alias("prev"), "tok",
                               (F.col("c_tok") / F.lit(float(model.n_tokens))).alias("p"))
    return seen.unionByName(uni)


def top_k(probs: DataFrame, k: int, slices: int = 64) -> DataFrame:
    """the ``k`` most likely successors per context (ties by token); adds ``rank``.

    Above Spark's group-limit threshold the plan has no map-side limit, so each
    context is ranked within ``slices`` slices of its successors first; what is left
    per context, at most ``slices * k`` rows, is ranked again. The result is the same.
    """
    order = [F.col("p").desc(), F.col("tok")]
    limit = int(probs.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > limit:
        part = F.pmod(F.xxhash64("tok"), F.lit(slices))
        first = Window.partitionBy("prev", "_part").orderBy(*order)
        probs = (probs.withColumn("_part", part).withColumn("_r", F.row_number().over(first))
                 .where(F.col("_r") <= k).drop("_part", "_r"))
    w = Window.partitionBy("prev").orderBy(*order)
    return probs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def temperature(cands: DataFrame, t: float) -> DataFrame:
    """``p ** (1/T)`` renormalised per context (a softmax of logits / T)."""
    w = Window.partitionBy("prev")
    q = F.pow(F.col("p"), F.lit(1.0 / t))
    return cands.withColumn("p", q / F.sum(q).over(w))


def top_p(cands: DataFrame, p: float) -> DataFrame:
    """keep the smallest prefix (by rank) whose mass reaches ``p``: a candidate
    stays when the mass ranked strictly above it is below ``p``. Renormalised."""
    w = Window.partitionBy("prev").orderBy("rank")
    before = F.coalesce(F.sum("p").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    kept = cands.withColumn("_before", before).where(F.col("_before") < p).drop("_before")
    return kept.withColumn("p", F.col("p") / F.sum("p").over(Window.partitionBy("prev")))


def sampling_table(model: BigramModel, k: int = 50, t: float = 1.0, p: float = 0.95) -> DataFrame:
    """``prev, cands`` where ``cands`` is the ordered array of ``(rank, tok, cdf)``
    after temperature, top-k and top-p; at most ``k`` entries per context."""
    c = top_k(next_token_probs(model), k)
    c = top_p(temperature(c, t), p)
    w = Window.partitionBy("prev").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    c = c.withColumn("cdf", F.sum("p").over(w))
    return c.groupBy("prev").agg(
        F.sort_array(F.collect_list(F.struct("rank", "tok", "cdf"))).alias("cands"))


def candidate_cells(cands: str) -> Column:
    """Cell measure of a candidate list: per candidate its token's bytes and two numbers."""
    return F.aggregate(cands, F.lit(0).cast("long"), lambda a, c: a + string_cells(c["tok"]) + 2)


def candidate_bytes(cands: str) -> Column:
    """Bytes of a candidate list as Arrow columns: token, its offset and a double; the context's own offsets."""
    return F.aggregate(cands, F.lit(16).cast("long"), lambda a, c: a + F.octet_length(c["tok"]) + 12)


def draw(cands: Column, u: Column) -> Column:
    """Inverse CDF - the first candidate whose cdf exceeds ``u`` (the last one
    if rounding leaves the top cdf a hair below 1)."""
    hit = F.filter(cands, lambda c: c["cdf"] > u)
    return F.coalesce(F.try_element_at(hit, F.lit(1)), F.try_element_at(cands, F.lit(-1)))["tok"]


def generate(model: BigramModel, prompts: DataFrame, prompt_col: str = "prompt",
             key: str = "prompt_id", max_new_tokens: int | None = 20,
             max_length: int | None = None, num_return_sequences: int = 1,
             k: int = 50, t: float = 1.0, p: float = 0.95, seed: int = 42,
             checkpoint_every: int = 20, broadcast_max_rows: int = 2_000_000,
             walk_bytes: int = WALK_BYTES) -> DataFrame:
    """``prompt_id, seq_no, prompt, generated_text`` for a whole prompt table.

    ``max_length`` counts prompt plus new tokens (the reference's meaning);
    ``max_new_tokens`` counts new tokens only. ``k = 1`` is greedy decoding.
    A candidate table of at most ``walk_bytes`` is broadcast and every row makes all its steps
    in one pass. Of a larger one the frequent contexts are broadcast: every row walks until it
    meets another context, the contexts that rows wait for are fetched in one scan, and the rows
    walk on (``_rounds``). With a bound of 0 the table is joined once per step; lineage is cut into the
    shared checkpoint folder every ``checkpoint_every`` steps. The samples are the same.
    """
    table = cut_lineage(sampling_table(model, k, t, p))
    # one pass over the written table: the back-off list (at most k entries, a
    # proven bound, kept as a literal) and the size of the context lookup
    is_ctx = F.col("prev") != BACKOFF
    stats = table.agg(
        F.first(F.when(~is_ctx, F.col("cands")), ignorenulls=True).alias("b"),
        F.count(F.when(is_ctx, F.lit(1))).alias("rows"),
        F.sum(F.when(is_ctx, string_cells("prev") + candidate_cells("cands"))).alias("cells"),
        F.sum(F.when(is_ctx, F.octet_length("prev") + candidate_bytes("cands"))).alias("bytes")).first()
    b_lit = F.lit(None).cast(table.schema["cands"].dataType)
    if stats["b"]:
        b_lit = F.array(*[F.struct(F.lit(c["rank"]).alias("rank"), F.lit(c["tok"]).alias("tok"),
                                   F.lit(c["cdf"]).alias("cdf")) for c in stats["b"]])
    ctx = table.where(is_ctx).withColumnRenamed("prev", "_last")
    ctx_size = (int(stats["rows"] or 0), int(stats["cells"] or 0))

    words = F.filter(F.split(F.col(prompt_col), " "), lambda x: x != "")
    state = prompts.select(
        key, prompt_col,
        F.explode(F.sequence(F.lit(1), F.lit(num_return_sequences))).alias("seq_no"),
        words.alias("_toks")).withColumn("_n0", F.size("_toks"))
    if max_length is not None:
        state = state.withColumn("_limit", F.greatest(F.lit(max_length) - F.col("_n0"), F.lit(0)))
        # no prompt can grow more than max_length minus the shortest prompt
        shortest = state.agg(F.min("_n0").alias("m")).first()["m"]
        steps = max(0, max_length - (shortest or 0))
    else:
        state = state.withColumn("_limit", F.lit(max_new_tokens))
        steps = max_new_tokens
    state = state.withColumn("_new", F.array().cast("array<string>"))

    text = F.when(F.size("_new") > 0, F.concat_ws(" ", F.col(prompt_col), F.array_join("_new", " "))) \
        .otherwise(F.col(prompt_col))
    if int(stats["bytes"] or 0) <= walk_bytes and broadcast_max_rows:
        walked = _walk(state, _store(ctx), stats["b"], key, seed, whole=True)
        return walked.select(key, "seq_no", prompt_col, text.alias("generated_text"))

    def step(state: DataFrame) -> DataFrame:
        last = F.coalesce(F.try_element_at("_new", F.lit(-1)), F.try_element_at("_toks", F.lit(-1)),
                          F.lit(BACKOFF))
        s = state.withColumn("_last", last)
        # prompts may pile onto one last token: size-checked, salted lookup
        s = lookup(s, ctx, ["_last"], "left", small_size=ctx_size, salt_cols=[key, "seq_no"],
                   broadcast_max_rows=broadcast_max_rows)
        u = uniform01(seed, key, "seq_no", F.size("_new"))
        nxt = draw(F.coalesce(F.col("cands"), b_lit), u)
        grow = F.size("_new") < F.col("_limit")
        return s.withColumn("_new", F.when(grow & nxt.isNotNull(), F.concat(
            "_new", F.array(nxt))).otherwise(F.col("_new"))).drop("_last", "cands")

    if walk_bytes and broadcast_max_rows:
        # a context takes at most k candidates; what it really takes is measured before the broadcast
        rows = 3 * walk_bytes // (4 * (24 * k + 40))
        top, _ = head_and_tail(model.context, model.context_size, "c_prev", rows, BROADCAST_MAX_CELLS)
        head = cut_lineage(ctx.join(F.broadcast(top.select(F.col("prev").alias("_last"))), "_last"))
        state = _rounds(state, ctx, head, stats["b"], key, seed, steps, walk_bytes, broadcast_max_rows, step)
    else:
        for i in range(steps):
            state = step(state)
            if (i + 1) % checkpoint_every == 0 and i + 1 < steps:
                state = cut_lineage(state)
    return state.select(key, "seq_no", prompt_col, text.alias("generated_text"))


def _store(ctx: DataFrame):
    """A bounded candidate table (its bytes checked by the caller) as Arrow columns."""
    return ctx.select("_last", F.transform("cands", lambda c: c["tok"]).alias("toks"),
                      F.transform("cands", lambda c: c["cdf"]).alias("cdfs")).toArrow()


def _rounds(state: DataFrame, ctx: DataFrame, head: DataFrame, backoff, key: str, seed: int, steps: int,
            walk_bytes: int, broadcast_max_rows: int, step) -> DataFrame:
    """All steps over a candidate table larger than the bound. Every round moves each unfinished row
    by one step at least: it walks over the known contexts, and the distinct ones that rows wait for
    are fetched. Where those exceed a quarter of the bound, the round takes one step by join."""
    def size(table: DataFrame) -> int:
        return int(table.agg(F.sum(F.octet_length("_last") + F.coalesce(candidate_bytes("cands"), F.lit(16)))).first()[0] or 0)

    import pyarrow as pa

    frequent = _store(head if size(head) <= walk_bytes * 3 // 4 else head.limit(0))
    shared, fetched, held = state.sparkSession.sparkContext.broadcast(frequent), None, 0
    for _ in range(steps + 1):
        state = cut_lineage(_walk(state, shared, backoff, key, seed, fetched))
        need = cut_lineage(state.where(F.col("_wait").isNotNull()).select(F.col("_wait").alias("_last")).distinct())
        state = state.drop("_wait")
        n = need.count()
        if not n:
            break
        found = None
        if n <= broadcast_max_rows:
            met = cut_lineage(ctx.join(F.broadcast(need), "_last"))
            # a context outside the table is known too: it has no candidates of its own
            found = need.join(met, "_last", "left")
        more = walk_bytes // 4 + 1 if found is None else size(found)
        if more > walk_bytes // 4:
            state, fetched, held = cut_lineage(step(state)), None, 0
        else:
            fresh = _store(found)
            keep = fetched is not None and held + more <= walk_bytes // 4
            fetched, held = (pa.concat_tables([fetched, fresh]), held + more) if keep else (fresh, more)
    return state


def _walk(state: DataFrame, store, backoff, key: str, seed: int, fetched=None, whole: bool = False) -> DataFrame:
    """Steps of every row in one pass: the candidate store (its bytes checked by the caller) goes to every
    worker once, and each row follows its own draws to its limit. Unless ``store`` is the ``whole`` table,
    a row stops at a context that neither store knows, which ``_wait`` names."""
    sc = state.sparkSession.sparkContext
    first = sc.broadcast(store) if whole else store
    second = sc.broadcast(fetched)
    spare = ([c["tok"] for c in backoff], [c["cdf"] for c in backoff]) if backoff else ([], [])
    none = BACKOFF
    coded = state.withColumn("_k", F.col(key).cast("string"))
    kept = [c for c in state.columns if c != "_new"]

    def run(batches):
        import hashlib
        from bisect import bisect_right

        import pyarrow as pa

        at, met = {}, {}
        for table in (first.value, second.value):
            if table is not None:
                table = table.combine_chunks()
                toks, cdfs = table["toks"], table["cdfs"]
                at.update((t, (toks, cdfs, i)) for i, t in enumerate(table["_last"].to_pylist()))

        def candidates(last):
            """None: to be fetched."""
            if last == none:
                return spare
            if last not in at:
                return spare if whole else None
            if last not in met:
                toks, cdfs, i = at[last]
                names = toks[i].as_py()
                met[last] = spare if names is None else (names, cdfs[i].as_py())
            return met[last]

        for b in batches:
            out, waits = [], []
            for k, n, limit, words, new in zip(*(b.column(c).to_pylist() for c in ("_k", "seq_no", "_limit", "_toks", "_new"))):
                new, wait = list(new), None
                last = new[-1] if new else words[-1] if words else none
                for step in range(len(new), limit or 0):
                    known = candidates(last)
                    if known is None:
                        wait = last
                        break
                    names, sums = known
                    if not names:
                        break
                    parts = [str(seed), *([] if k is None else [k]), str(n), str(step)]
                    u = int(hashlib.md5(":".join(parts).encode()).hexdigest()[:8], 16) / 4294967296.0
                    last = names[min(bisect_right(sums, u), len(names) - 1)]
                    new.append(last)
                out.append(new)
                waits.append(wait)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(out, pa.list_(pa.string())), pa.array(waits, pa.string())],
                                             names=[*kept, "_new", "_wait"])

    kind = T.StructType([*[state.schema[c] for c in kept], T.StructField("_new", T.ArrayType(T.StringType())),
                         T.StructField("_wait", T.StringType())])
    return coded.select(*kept, "_new", "_k").mapInArrow(run, kind)


def render_samples(samples: DataFrame, key: str = "prompt_id", per_prompt_header: bool = True) -> DataFrame:
    """The generated-text file as one text block per prompt.

    ``per_prompt_header`` is the prompt-file layout (``Prompt:`` once per prompt);
    otherwise ``Prompt:`` repeats before every sequence (single-prompt layout).
    Groups hold ``num_return_sequences`` rows.
    """
    entry = F.format_string(SAMPLE_HEADER, F.col("seq_no"), F.col("generated_text"))
    if not per_prompt_header:
        entry = F.concat(F.format_string(PROMPT_LINE, F.col("prompt")), entry)
    g = samples.groupBy(key, "prompt").agg(
        F.sort_array(F.collect_list(F.struct("seq_no", entry.alias("e")))).alias("_es"))
    body = F.array_join(F.transform("_es", lambda x: x["e"]), "")
    if per_prompt_header:
        body = F.concat(F.format_string(PROMPT_LINE, F.col("prompt")), body)
    return g.select(key, body.alias("block"))
