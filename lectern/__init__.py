"""lectern: text-corpus preparation and count-model data operators on Spark.

Every operator is a function from DataFrames (plus parameters) to a DataFrame,
built from Spark's own expressions, joins, windows and aggregations. The names
below are the public API; submodules hold the details.
"""

from .functions.text import (archive_query, clean_text, landing_path, normalize_ws,
                             sanitize_name, split_lines, strip_footer, strip_header,
                             strip_ws)
from .operators.catalog import (candidate_items, fetch_status, fetch_tally, items_with_text,
                                new_files_only, planned_downloads, resolve_works, text_files,
                                unresolved_works, works_routable)
from .operators.generate import generate, render_samples, sampling_table, temperature, top_k, top_p
from .operators.joins import lookup
from .operators.lines import clean_lines, number_files, number_lines
from .operators.lm import (best_model, eval_loss, fit_bigram, grid_losses, load_model, pair_counts,
                           perplexity, retained_models, save_model)
from .operators.pack import cut_blocks, pack_batch, pack_document, pack_file, pack_stats, token_offsets
from .operators.prefix import dense_ordinal, hash_rank, running_offsets
from .operators.resolve import resolve_ranked
from .operators.schedule import batch_plan, block_keys, step_events
from .operators.split import split_exact
from .operators.tokenize import (detokenize, fit_vocab, map_batches, special_tokens, token_rows, tokenize,
                                 tokenize_bytes, tokenize_with)
from .plans.prepare import (create_dataset, create_dataset_from_lines, generate_text, preprocess, run_all,
                            run_create_dataset, run_create_dataset_from_lines, run_evaluate, run_generate,
                            run_preprocess)
from .session import build_session, cut_lineage, ensure_checkpoint_dir
from .sources.files import (load_table, parse_works, read_lines, read_prompts, read_text_files,
                            read_works)
from .sources.sinks import metrics_report, save_splits, save_table, write_text

__version__ = "0.1.0"
