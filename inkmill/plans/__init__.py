"""All named queries."""

from . import evaluation, example_sets, inference, shaping, storage, streams, tokenizers  # noqa: F401
from .registry import REGISTRY  # noqa: F401
