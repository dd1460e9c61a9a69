"""Deterministic stand-ins for a model, for the registered queries and tests.

Their output is a fixed function of the prompt (and seed), so SQL can state it.
They are not registered as backends.
"""

from __future__ import annotations

from collections.abc import Iterator

from synthtext.operators.backends import BackendSpec


class EchoBackend:
    """Formats each prompt with a template of ``{prompt}``, ``{index}`` (which
    of the prompt's texts) and ``{seed}``; streams it word by word."""

    name = "echo"

    def __init__(self, template: str = "{prompt}"):
        self.template = template

    def _text(self, prompt: str, index: int, seeds, i: int) -> str:
        return self.template.format(prompt=prompt, index=index, seed=seeds[i] if seeds else None)

    def generate(self, prompts: list[str], params: dict, seeds=None) -> list[list[str]]:
        n = int(params.get("n", 1) or 1)
        return [[self._text(p, k, seeds, i) for k in range(n)] for i, p in enumerate(prompts)]

    def stream(self, prompts: list[str], params: dict, seeds=None) -> Iterator[tuple[int, int, int, str, bool]]:
        for i, p in enumerate(prompts):
            for k in range(int(params.get("n", 1) or 1)):
                text = self._text(p, k, seeds, i)
                at, seq = text.find(" "), 0
                while at >= 0:
                    yield i, k, seq, text[:at], False
                    at, seq = text.find(" ", at + 1), seq + 1
                yield i, k, seq, text, True


class BatchOnlyEchoBackend(EchoBackend):
    """Without ``stream``: the batch fallback (ST3)."""

    stream = None  # type: ignore[assignment]


def echo(template: str = "{prompt}") -> BackendSpec:
    return BackendSpec.from_factory("echo", EchoBackend, template=template)


def batch_only_echo(template: str = "{prompt}") -> BackendSpec:
    return BackendSpec.from_factory("echo_batch_only", BatchOnlyEchoBackend, template=template)


class EvenSeedEcho(EchoBackend):
    """Has no text for prompts of odd seeds."""

    def generate(self, prompts: list[str], params: dict, seeds=None) -> list[list[str]]:
        return [texts if seeds[i] % 2 == 0 else [] for i, texts in enumerate(super().generate(prompts, params, seeds))]


def even_seed_echo(template: str = "{prompt}") -> BackendSpec:
    return BackendSpec.from_factory("echo_even_seeds", EvenSeedEcho, template=template)
