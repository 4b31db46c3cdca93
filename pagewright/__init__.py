"""pagewright: document analytics expressed as Spark DataFrame plans."""

from pagewright.config import EngineConfig

__all__ = ["EngineConfig"]
__version__ = "0.1.0"
