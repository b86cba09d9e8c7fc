"""changeflow: change-data capture as Spark plans, and corpus operators in the subpackage ``llm``."""

__version__ = "0.1.0"
