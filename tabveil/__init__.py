"""Private microdata on Spark: coding, marginals, noise, synthesis, utility."""

import sys

from pyspark import cloudpickle

from tabveil.spec import Marginal, MicrodataSpec, PrivacyBudget, SynthesisSettings

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Marginal", "MicrodataSpec", "PrivacyBudget", "SynthesisSettings"]
