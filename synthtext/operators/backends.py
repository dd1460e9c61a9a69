"""Generation backends (U4): a registry of user-supplied factories.

A backend turns a list of prompts into texts. The model runtime itself is the
user's (an inference server client, a local model, ...); this module only
fixes the calling convention and builds each backend once per Python worker.

Protocol::

    class Backend:
        name: str
        def generate(self, prompts: list[str], params: dict,
                     seeds: list[int] | None = None) -> list[list[str]]:
            '''One list of ``params["n"]`` texts per prompt, in prompt order.'''
        # optional
        def stream(self, prompts, params, seeds=None):
            '''Yields (index, sequence, seq, text_so_far, finished) chunks:
            prompt, which of its texts, and the chunk's number.'''
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import cloudpickle

_FACTORIES: dict[str, Callable[..., object]] = {}
_INSTANCES: dict[tuple, object] = {}


def register_backend(name: str, factory: Callable[..., object]) -> None:
    """U4: make ``factory(**options)`` available under ``name``."""
    _FACTORIES[name] = factory


def backend_names() -> list[str]:
    return sorted(_FACTORIES)


def factory_digest(factory: Callable[..., object]) -> str:
    """Digest of a pickled factory: what a worker may key a built object on."""
    return hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()


@dataclass(frozen=True)
class BackendSpec:
    """What a task needs to build a backend: name, options and the factory.

    The factory is pickled into the task closure, so backends registered in the
    driver process work on executors too; the backend itself is built on the
    worker. ``digest`` tells factories of one name apart."""

    name: str
    options: tuple
    factory: Callable[..., object]
    digest: str

    @staticmethod
    def of(name: str, **options) -> "BackendSpec":
        """A registered backend."""
        factory = _FACTORIES.get(name)
        if factory is None:
            raise KeyError(f"unknown backend {name!r}; registered: {backend_names()}")
        return BackendSpec.from_factory(name, factory, **options)

    @staticmethod
    def from_factory(name: str, factory: Callable[..., object], **options) -> "BackendSpec":
        return BackendSpec(name, tuple(sorted(options.items())), factory, factory_digest(factory))


def get_backend(spec: BackendSpec):
    """Lazily build (once per Python worker) and return the backend."""
    key = (spec.name, spec.options, spec.digest)
    inst = _INSTANCES.get(key)
    if inst is None:
        inst = _INSTANCES[key] = spec.factory(**dict(spec.options))
    return inst
