"""Monthly media sentiment per country from landed news search results, on Spark."""

from mediasignal.config import PipelineConfig
from mediasignal.operators.score import score
from mediasignal.plans.collect import collect
from mediasignal.plans.enrich import enrich
from mediasignal.plans.runner import run_stages
from mediasignal.session import build_session
from mediasignal.sources.datasets import Datasets

__all__ = ["Datasets", "PipelineConfig", "build_session", "collect", "enrich", "run_stages", "score"]
