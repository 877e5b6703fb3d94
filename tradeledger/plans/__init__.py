"""Reports. Each is ``report(star, **params) -> DataFrame``."""
