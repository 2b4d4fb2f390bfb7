"""Hooks: functions of tables that users plug into steps, and feature flags."""

from __future__ import annotations

import importlib.util
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import wraps
from typing import Any

#: Names under which functions can be plugged in.
NAMES = ("post_transform", "metadata_transform", "documents_clean", "pre_chunk", "post_chunk", "pre_embed", "post_embed", "run")


@dataclass
class Hooks:
    found: dict[str, list[Callable]] = field(default_factory=lambda: defaultdict(list))

    def register(self, name: str, function: Callable) -> Callable:
        if name not in NAMES:
            raise ValueError(f"unknown hook: {name}")
        self.found[name].append(function)
        return function

    def load(self, path: str) -> list[str]:
        """Register all functions of a Python file that bear a hook's name."""
        spec = importlib.util.spec_from_file_location(f"docloom_plugin_{abs(hash(path))}", path)
        if spec is None or spec.loader is None:
            raise ValueError(f"not a Python file: {path}")
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        named = [n for n in NAMES if callable(getattr(module, n, None))]
        for name in named:
            self.register(name, getattr(module, name))
        return named

    def apply(self, name: str, value: Any, *args: Any, **kwargs: Any) -> Any:
        """The first registered function's result; the value itself without one or if it returns None."""
        for function in self.found.get(name, ())[:1]:
            out = function(value, *args, **kwargs)
            return value if out is None else out
        return value


@dataclass
class Flags:
    """Features that are on unless switched off."""

    translate: bool = True
    chunk_metadata: bool = True
    root_document: bool = True

    def gated(self, name: str, returns: str | None = None, default: Any = None) -> Callable:
        """A decorated function runs only while its flag is on; else its named argument, or the default, comes back."""

        def around(function: Callable) -> Callable:
            @wraps(function)
            def call(*args: Any, **kwargs: Any) -> Any:
                if getattr(self, name):
                    return function(*args, **kwargs)
                if returns is None:
                    return default
                names = function.__code__.co_varnames[: function.__code__.co_argcount]
                return kwargs.get(returns, dict(zip(names, args)).get(returns, default))

            return call

        return around
