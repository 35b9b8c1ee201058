from lumenpath.sources.platform import Platform

__all__ = ["Platform"]
