"""DataFrame operators: ``(DataFrame..., params) -> DataFrame``, no side effects."""
