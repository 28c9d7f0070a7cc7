"""Parameters of a preparation run, checked once on the driver."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from winnower import fixed_values as fixed


@dataclass(frozen=True)
class CleaningRules:
    """Thresholds of the quality rules."""

    min_question_chars: int = fixed.MIN_QUESTION_CHARS
    min_response_chars: int = fixed.MIN_RESPONSE_CHARS
    max_question_chars: int = fixed.MAX_QUESTION_CHARS
    max_response_chars: int = fixed.MAX_RESPONSE_CHARS
    drop_if_char_run_ge: int = fixed.CHAR_RUN_LIMIT
    drop_if_rep_ratio_ge: float = fixed.TOKEN_SHARE_LIMIT
    rep_ratio_min_tokens: int = fixed.TOKEN_SHARE_MIN_TOKENS

    def as_dict(self) -> dict:
        return asdict(self)


@dataclass(frozen=True)
class Sampling:
    """Which share of the valid rows to select, and by which seed.

    The probability is ``hash_prob`` if given, else ``max_samples`` over the
    number of source rows, so the result holds about ``probability`` x valid
    rows; it is not topped up to ``max_samples``.
    """

    max_samples: int = fixed.MAX_SAMPLES
    hash_prob: float | None = None
    seed: int = fixed.SEED
    source_rows: int = fixed.SOURCE_ROWS

    def __post_init__(self) -> None:
        if not 0.0 < self.probability <= 1.0:
            raise ValueError(f"selection probability {self.probability} is not in (0, 1]")
        if not 0 <= self.seed < 2**64:
            raise ValueError(f"seed {self.seed} does not fit 8 unsigned bytes")

    @property
    def probability(self) -> float:
        if self.hash_prob is not None:
            return float(self.hash_prob)
        return min(1.0, max(0.0, self.max_samples / self.source_rows))
