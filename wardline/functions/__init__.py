from . import clean, gen, keys  # noqa: F401
