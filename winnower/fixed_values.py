"""Thresholds, names and lists that results depend on.

Nothing here is computed; every other module takes these as defaults.
"""

# Cleaning thresholds (inclusive bounds are kept).
MIN_QUESTION_CHARS = 10
MIN_RESPONSE_CHARS = 20
MAX_QUESTION_CHARS = 8_000
MAX_RESPONSE_CHARS = 16_000
CHAR_RUN_LIMIT = 120
TOKEN_SHARE_LIMIT = 0.4
TOKEN_SHARE_MIN_TOKENS = 80

# Sampling.
SOURCE_ROWS = 1_000_000
SOURCE_REVISION = "e9c87b4"
MAX_SAMPLES = 250_000
SEED = 42

# Reporting.
DEMO_ROWS = 200

# Columns of an instruction record as a training data manifest names them.
MANIFEST_COLUMNS = {
    "prompt": "instruction",
    "query": "input",
    "response": "output",
    "system": "system",
    "history": "history",
}

# Benchmark tasks in report order, with their few-shot counts.
TASKS = [
    ("mmlu", 5),
    ("arc_easy", 0),
    ("arc_challenge", 25),
    ("hellaswag", 10),
    ("winogrande", 5),
    ("truthfulqa_mc2", 0),
    ("piqa", 0),
    ("boolq", 0),
]

# Metric names to look for, best first.
PREFERRED_METRICS = {
    "mmlu": ["acc,none", "acc"],
    "arc_easy": ["acc,none", "acc_norm,none", "acc", "acc_norm"],
    "arc_challenge": ["acc,none", "acc_norm,none", "acc", "acc_norm"],
    "hellaswag": ["acc_norm,none", "acc,none", "acc_norm", "acc"],
    "winogrande": ["acc,none", "acc"],
    "truthfulqa_mc2": ["mc2,none", "mc2"],
    "piqa": ["acc,none", "acc"],
    "boolq": ["acc,none", "acc"],
}

# The two header lines of a Markdown comparison.
MARKDOWN_HEADER = [
    "| task | fewshot | metric | base | sft | delta |",
    "|---|---:|---|---:|---:|---:|",
]
