from . import bits, exif, paths, text, vectors  # noqa: F401
