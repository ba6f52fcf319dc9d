from finecast.functions import columns, geo, names, spectral, weather  # noqa: F401
