class EngineError(Exception):
    """A guard refused to go on: what was read cannot be trusted or stored."""
