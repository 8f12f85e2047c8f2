"""Parameters and fixed values shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference behaviour for the same results).
# ---------------------------------------------------------------------------
SEED = 42                       # shuffle / split seed
PREFIX_CHARS = 1000             # key of the prefix dedup: first 1,000 characters
MAX_LENGTH = 32768              # sequence length (tokens) for encode and pack
MIN_CHARS = 50                  # quality: minimum characters
QUALITY_MAX_LENGTH = 8192       # quality: max characters = 4 * this
REPETITION_MIN = 0.3            # quality: distinct chars / length
PRINTABLE_MIN = 0.9             # quality: printable chars / length
HOLDOUT_PERCENT = 1             # validation + test share, percent of rows
BATCH_SIZE = 2                  # per-device batch
GRAD_ACCUM = 16                 # gradient accumulation
LOGGING_STEPS = 10
EVAL_STEPS = 500
SAVE_STEPS = 500
SAVE_TOTAL_LIMIT = 5
PERPLEXITY_CAP = 20.0           # exp(min(loss, 20))
LABEL_IGNORE = -100
BYTES_PER_TOKEN = 4
MCQ_NEW_TOKENS = 10
ROUGE_NEW_TOKENS = 256
ROUGE_SOURCE_TRUNCATION = 4096

# The end-to-end plans keep long texts: no upper bound, and no threshold on the share
# of distinct characters, which falls with length in any text.  Both rules are one
# argument away; the operator defaults are the fixed values above.
PLAN_REPETITION_MIN = 0.0

# Prompt text of the multiple-choice evaluation (fixed values).
MCQ_HEADER = "Pertanyaan: "
MCQ_CHOICES_HEADER = "\n\nPilihan:\n"
MCQ_FOOTER = "\nJawaban yang benar adalah huruf:"

# Request payload constants of the completion client (fixed values).
SERVED_MODEL = "served-model"   # name of the deployed model (a parameter)
REQUEST_MAX_TOKENS = 1024
REQUEST_TEMPERATURE = 0.7

# Benchmark registry (fixed values): name, description, dataset, metric, split.
BENCHMARKS = [
    ("indommlu", "Indonesian MMLU — knowledge and reasoning", "indonlp/indommlu", "accuracy", "test"),
    ("indonlg", "Indonesian NLG — generation quality", "indonlp/indonlg", "rouge", "test"),
    ("nusax", "NusaX — Regional language sentiment + translation", "indonlp/nusax", "accuracy", "test"),
    ("indo4b", "Indo4B — NLI, QA, sentiment, POS", "indonlp/indo4b", "accuracy", "test"),
]


@dataclass(frozen=True)
class SpecialIds:
    """Special token ids.  ``pad=None`` means "use eos" (the reference policy)."""

    pad: int | None = 0
    bos: int = 1
    eos: int = 2
    unk: int = 3

    @property
    def pad_id(self) -> int:
        return self.eos if self.pad is None else self.pad

    @property
    def first_word_id(self) -> int:
        return max(x for x in (self.pad_id, self.bos, self.eos, self.unk)) + 1

    @property
    def count(self) -> int:
        return len({self.pad_id, self.bos, self.eos, self.unk})


DEFAULT_IDS = SpecialIds()


@dataclass(frozen=True)
class QualityParams:
    min_chars: int = MIN_CHARS
    max_length: int | None = QUALITY_MAX_LENGTH   # None: no upper bound
    repetition_min: float = REPETITION_MIN
    printable_min: float = PRINTABLE_MIN

    @property
    def max_chars(self) -> int | None:
        return None if self.max_length is None else self.max_length * 4


PLAN_QUALITY = QualityParams(max_length=None, repetition_min=PLAN_REPETITION_MIN)
