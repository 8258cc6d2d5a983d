from . import contracts, emergency, model, waiting

__all__ = ["contracts", "emergency", "model", "waiting"]
