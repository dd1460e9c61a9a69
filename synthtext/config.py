"""Run settings as plain frozen dataclasses (driver side).

Defaults are the documented defaults of the generation and post-processing
settings. When many run records must be checked they are *data*, not these
objects: see ``synthtext.operators.checks``.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field


# The documented defaults of the post-processing, generation and
# logging settings are the dataclass defaults below.


@dataclass(frozen=True)
class PostProcessing:
    """X6 settings. ``max_length=None`` skips truncation."""

    enabled: bool = True
    max_length: int | None = 2048
    complete_sentences: bool = True
    deduplicate: bool = True
    # Validated by the rule checks, but only applied when asked for (F2).
    min_length: int | None = None


@dataclass(frozen=True)
class Generation:
    """Sampling parameters and batching (P5 defaults)."""

    temperature: float = 0.8
    top_p: float = 0.92
    top_k: int = 50
    repetition_penalty: float = 1.0
    max_length: int = 1024
    min_length: int = 10
    num_return_sequences: int = 1
    do_sample: bool = True
    batch_size: int = 16
    prompt_template: str = "{prompt}"
    prompt_file: str | None = None
    num_prompts: int = 1000
    seed: int = 42

    def record_parameters(self) -> dict:
        """The parameter block stored with every output record."""
        return {
            "temperature": float(self.temperature),
            "top_p": float(self.top_p),
            "top_k": int(self.top_k),
            "max_length": int(self.max_length),
        }


@dataclass(frozen=True)
class Logging:
    """Cadence of progress and logged samples (F3, W1, W2); metric events are
    written for every batch."""

    log_interval: int = 100
    log_samples: int = 10
    token_diversity: bool = True


@dataclass(frozen=True)
class Output:
    dir: str = "./outputs"
    format: str = "jsonl"


@dataclass(frozen=True)
class RunConfig:
    model_name: str = "model"
    backend: str | None = None  # name of a registered backend
    generation: Generation = field(default_factory=Generation)
    post_processing: PostProcessing = field(default_factory=PostProcessing)
    logging: Logging = field(default_factory=Logging)
    output: Output = field(default_factory=Output)

    def to_dict(self) -> dict:
        return asdict(self)
