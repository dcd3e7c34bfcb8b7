"""End-to-end flows: the reference's stages as one Spark job each.

``preprocess`` is the line-oriented flow (lines -> tokens -> blocks of each
1,000-line batch -> split), ``create_dataset`` the document flow (whole text ->
tokens -> blocks -> split). ``run_*`` read files and write Parquet, so a stage
boundary is a written table a later job (or a retried one) starts from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..operators import generate as gen
from ..operators import lm
from ..operators.joins import lookup, string_cells, table_size
from ..operators.lines import clean_lines, number_files, number_lines
from ..operators.pack import pack_batch, pack_document, pack_file, with_batches
from ..operators.schedule import batch_plan
from ..operators.split import split_exact
from ..operators.tokenize import detokenize, fit_vocab, token_rows, tokenize, tokenize_bytes, tokenize_with
from ..session import cut_lineage
from ..sources.files import read_lines, read_prompts, read_text_files
from ..sources.sinks import metrics_report, save_splits, save_table, write_text


def _tokenized(df: DataFrame, keys: list[str], tokenizer, vocab: DataFrame | None,
               keep: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """L2: a tokenizer by name ('whitespace', 'words', 'bytes') or a callable
    ``str -> list[int]`` applied to distinct whitespace pre-tokens."""
    if callable(tokenizer):
        out = tokenize_with(df, tokenizer, keys, "text")
        if keep:
            out = out.join(df.select(*keys, *keep), keys)
        return out, None
    if tokenizer == "bytes":
        return tokenize_bytes(df, keys, "text", keep=keep), None
    if vocab is None:
        vocab = fit_vocab(token_rows(df, keys, "text", tokenizer))
    return tokenize(df, vocab, keys, "text", scheme=tokenizer, keep=keep), vocab


def preprocess(lines: DataFrame, block_size: int = 1024, tokenizer: str = "whitespace",
               vocab: DataFrame | None = None, batch_rows: int = 1000, test_size: float = 0.1,
               seed: int = 42, clean: bool = True) -> DataFrame:
    """Lines ``path, line_no, row_idx, text`` -> blocks packed per batch of ``batch_rows``
    lines -> exact split. With ``clean`` each file's header and footer go and lines are
    whitespace-normalised; without it the raw lines are tokenized, as the reference
    does (its cleaned text is computed and then not used). ``path`` and ``line_no`` are
    only needed for cleaning."""
    if clean:
        lines = clean_lines(lines, "path", "line_no")
    ln = lines.select("row_idx", "text")
    if vocab is None and isinstance(tokenizer, str) and tokenizer != "bytes":
        ln = cut_lineage(ln)           # read by the vocabulary fit and by the tokenizer
    tok, _ = _tokenized(ln, ["row_idx"], tokenizer, vocab, [])
    # partitioned by batch after the last write, so that the windows and blocks keep it
    blocks = pack_batch(with_batches(tok, batch_rows, "row_idx"), block_size, batch_rows, "row_idx", batch_col="batch_id")
    return split_exact(blocks, ["scope_id", "block_id"], test_size, seed, materialize=True)


def create_dataset(docs: DataFrame, block_size: int = 1024, tokenizer: str = "whitespace",
                   vocab: DataFrame | None = None, clean: bool = True, test_size: float = 0.1,
                   seed: int = 42, per_document_split: bool = False) -> DataFrame:
    """Documents ``doc_id, text`` -> (cleaned) -> tokens -> blocks per document ->
    exact split (over all blocks, or per document with ``per_document_split``)."""
    d = docs.select("doc_id", (clean_text("text") if clean else F.col("text")).alias("text"))
    tok, _ = _tokenized(d, ["doc_id"], tokenizer, vocab, [])
    blocks = pack_document(tok, block_size, "doc_id")
    scope = ["scope_id"] if per_document_split else []
    return split_exact(blocks, ["scope_id", "block_id"], test_size, seed, scope=scope,
                       materialize=True)


def create_dataset_from_lines(lines: DataFrame, block_size: int = 1024,
                              tokenizer: str = "whitespace", vocab: DataFrame | None = None,
                              test_size: float = 0.1, seed: int = 42, clean: bool = True) -> DataFrame:
    """Same blocks as ``create_dataset`` for files too long to be one row: each file
    (``doc_id``) is one token stream over its lines (I10). With ``clean`` header and
    footer are cut at per-file positions."""
    if clean:
        lines = clean_lines(lines, "doc_id", "row_idx")
    ln = lines.select("doc_id", "row_idx", "text")
    tok, _ = _tokenized(ln, ["row_idx"], tokenizer, vocab, ["doc_id"])
    blocks = pack_file(tok, block_size, "doc_id", "row_idx")
    return split_exact(blocks, ["scope_id", "block_id"], test_size, seed, materialize=True)


def _numbered(spark: SparkSession, input_path: str) -> DataFrame:
    """The files' lines with ``row_idx`` and ``doc_id``, numbered and written once: the
    file counts, the vocabulary and the tokens all read this table."""
    return cut_lineage(number_lines(cut_lineage(read_lines(spark, input_path))))


def run_preprocess(spark: SparkSession, input_path: str, output_dir: str,
                   counts: dict | None = None, **kw) -> str:
    """Read a text file (or folder), preprocess, write ``output_dir`` partitioned by
    split. ``counts`` receives the rows per split, observed during the write."""
    return save_splits(preprocess(_numbered(spark, input_path), **kw), output_dir, counts=counts)


def documents_of(spark: SparkSession, input_path: str) -> DataFrame:
    """Whole files as ``doc_id, text``; ids are dense in path order."""
    files = read_text_files(spark, input_path).select("path", "text")
    ids = number_files(spark.read.format("binaryFile").load(input_path).select("path"))
    size = table_size(ids, string_cells("path") + 1)
    return lookup(files, ids, ["path"], "inner", salt=1, small_size=size).select("doc_id", "text")


def _save_dataset(ds: DataFrame, output_dir: str, counts: dict | None) -> str:
    # one computation, written to the shared checkpoint folder, feeds both writes
    ds = cut_lineage(ds)
    save_table(ds.where(F.col("split") == "train").drop("split"), output_dir, "train_dataset", counts)
    save_table(ds.where(F.col("split") == "validation").drop("split"), output_dir, "val_dataset", counts)
    return output_dir


def run_create_dataset(spark: SparkSession, input_path: str, output_dir: str,
                       counts: dict | None = None, **kw) -> str:
    """Read whole files, build the dataset, write ``train`` and ``validation``.
    ``counts`` receives the rows written per dataset, observed during the writes."""
    return _save_dataset(create_dataset(documents_of(spark, input_path), **kw), output_dir, counts)


def run_create_dataset_from_lines(spark: SparkSession, input_path: str, output_dir: str,
                                  counts: dict | None = None, **kw) -> str:
    """``run_create_dataset`` for files of any length: read by lines, with many tasks
    to a file, and the same datasets."""
    return _save_dataset(create_dataset_from_lines(_numbered(spark, input_path), **kw), output_dir, counts)


def ids_as_tokens(blocks: DataFrame) -> DataFrame:
    """Blocks' ``input_ids`` as token strings, the count model's input."""
    return blocks.select("scope_id", "block_id", "split",
                         F.transform("input_ids", lambda x: x.cast("string")).alias("toks"))


def run_evaluate(spark: SparkSession, model_dir: str, dataset_dir: str, output_dir: str, lam: float = 0.5) -> str:
    """Evaluate a saved model on a saved dataset's validation rows; write the report."""
    held_out = ids_as_tokens(spark.read.parquet(dataset_dir).where(F.col("split") == "validation"))
    loss = lm.eval_loss(lm.load_model(spark, model_dir), held_out, "toks", lam)
    report = metrics_report(loss, "eval_loss", {"eval_loss": "%s", "eval_tokens": "%d"}, {"eval_tokens": "n_tokens"})
    return write_text(report.coalesce(1), output_dir, "line", order_by="line_no")


def generate_text(model: lm.BigramModel, vocab: DataFrame, prompts: DataFrame, max_length: int = 100,
                  num_return_sequences: int = 1, temperature: float = 0.7, top_k: int = 50,
                  top_p: float = 0.9, seed: int = 42) -> DataFrame:
    """``prompt_id, seq_no, prompt, generated_text`` as text: prompts are encoded with
    the vocabulary, the model continues its ids, and the new ids are decoded after the
    prompt as it was given."""
    enc = tokenize(prompts.withColumnRenamed("prompt", "text"), vocab, ["prompt_id"], "text")
    coded = enc.select("prompt_id", F.array_join(F.transform("input_ids", lambda x: x.cast("string")), " ").alias("prompt"))
    samples = gen.generate(model, coded, max_new_tokens=None, max_length=max_length,
                           num_return_sequences=num_return_sequences, k=top_k, t=temperature, p=top_p, seed=seed)
    n = F.size(F.filter(F.split("prompt", " "), lambda x: x != ""))
    ids = F.filter(F.split("generated_text", " "), lambda x: x != "")
    new = samples.select("prompt_id", "seq_no", F.slice(ids, n + 1, F.greatest(F.size(ids) - n, F.lit(0))).cast(
        "array<int>").alias("input_ids"))
    words = detokenize(new, vocab, ["prompt_id", "seq_no"], out="_new")
    return words.join(prompts.select("prompt_id", "prompt"), "prompt_id").select(
        "prompt_id", "seq_no", "prompt", F.when(F.col("_new") != "", F.concat_ws(" ", "prompt", "_new"))
        .otherwise(F.col("prompt")).alias("generated_text"))


def write_samples(samples: DataFrame, path: str, per_prompt_header: bool = True) -> str:
    """The generated-text file, prompts in order; ``per_prompt_header`` is the
    prompt-file layout, otherwise ``Prompt:`` precedes every sequence."""
    blocks = gen.render_samples(samples, "prompt_id", per_prompt_header)
    # the writer adds a block's last line end; parts of the folder follow the prompt order
    ordered = blocks.repartitionByRange("prompt_id").sortWithinPartitions("prompt_id")
    ordered.select(F.expr("substring(block, 1, length(block) - 1)").alias("value")).write.mode("overwrite").option("lineSep", "\n").text(path)
    return path


def run_generate(spark: SparkSession, model_dir: str, vocab_dir: str, output_dir: str,
                 prompts_path: str | None = None, prompt: str | None = None, **kw) -> str:
    """Generate from a saved model: for a prompts file (one prompt per line), or for a
    single prompt. Writes the samples as a table and as the text file of that mode."""
    if (prompts_path is None) == (prompt is None):
        raise ValueError("give either prompts_path or prompt")
    prompts = read_prompts(spark, prompts_path) if prompts_path else spark.createDataFrame(
        [(0, prompt)], "prompt_id bigint, prompt string")
    samples = cut_lineage(generate_text(lm.load_model(spark, model_dir), spark.read.parquet(vocab_dir), prompts, **kw))
    out = output_dir.rstrip("/")
    save_table(samples, out, "table")
    write_samples(samples, f"{out}/text", per_prompt_header=prompts_path is not None)
    return output_dir


def run_all(spark: SparkSession, input_path: str, output_dir: str, block_size: int = 1024,
            lam: float = 0.5, prompts_path: str | None = None, max_length: int = 100,
            num_return_sequences: int = 1, temperature: float = 0.7, top_k: int = 50,
            top_p: float = 0.9, seed: int = 42, epochs: int = 3, batch_size: int = 1) -> dict[str, str]:
    """The reference's stage order as Spark jobs, each stage starting from the tables the
    one before wrote: dataset (train / validation blocks) and vocabulary -> training
    plan -> fitted count model -> evaluation report -> generated text for a prompts
    file (optional)."""
    out = output_dir.rstrip("/")
    paths = {"dataset": f"{out}/dataset", "vocab": f"{out}/vocab", "plan": f"{out}/plan", "model": f"{out}/model",
             "report": f"{out}/eval_results"}
    docs = cut_lineage(documents_of(spark, input_path).select("doc_id", clean_text("text").alias("text")))
    vocab = cut_lineage(fit_vocab(token_rows(docs, ["doc_id"], "text")))
    save_table(vocab, out, "vocab")
    save_splits(create_dataset(docs, block_size, vocab=vocab, clean=False, seed=seed), paths["dataset"])

    train = spark.read.parquet(paths["dataset"]).where(F.col("split") == "train")
    save_table(batch_plan(train, ["scope_id", "block_id"], epochs, batch_size, seed), out, "plan")
    lm.save_model(lm.fit_bigram(ids_as_tokens(train), "toks"), paths["model"])
    run_evaluate(spark, paths["model"], paths["dataset"], paths["report"], lam)
    if prompts_path:
        paths["samples"] = run_generate(
            spark, paths["model"], paths["vocab"], f"{out}/samples", prompts_path, max_length=max_length,
            num_return_sequences=num_return_sequences, temperature=temperature, top_k=top_k, top_p=top_p, seed=seed)
    return paths
