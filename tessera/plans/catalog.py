"""Import every query module so that each registers its keys."""

from tessera.plans import (  # noqa: F401
    q_answers, q_classify, q_genmetrics, q_io, q_models, q_runs, q_sequences, q_stream)
