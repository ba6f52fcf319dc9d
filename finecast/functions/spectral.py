"""Satellite bands: masks, indices, radar differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from finecast.functions.columns import safe_ratio

# Reflectance scale, mask classes and bit positions.
REFLECTANCE_SCALE = 0.0001
SCENE_CLASSES_MASKED = (3, 8, 9, 10, 11)
OPTICAL_QA_BITS = (10, 11)
THERMAL_QA_BITS = (0, 1, 2, 3, 4, 5)
THERMAL_QA_BITS_AREA = (1, 2, 3, 4, 5)


def reflectance(dn: Column) -> Column:
    return dn * F.lit(REFLECTANCE_SCALE)


def normalised_difference(a: Column, b: Column) -> Column:
    return safe_ratio(a - b, a + b)


def ndvi(nir: Column, red: Column) -> Column:
    return normalised_difference(nir, red)


def ndmi(nir: Column, swir1: Column) -> Column:
    return normalised_difference(nir, swir1)


def nbr(nir: Column, swir2: Column) -> Column:
    return normalised_difference(nir, swir2)


def savi(nir: Column, red: Column) -> Column:
    return safe_ratio((nir - red) * F.lit(1.5), nir + red + F.lit(0.5))


def evi(nir: Column, red: Column, blue: Column) -> Column:
    return safe_ratio(
        (nir - red) * F.lit(2.5),
        nir + red * F.lit(6.0) - blue * F.lit(7.5) + F.lit(1.0),
    )


def clear_bits(qa: Column, bits=OPTICAL_QA_BITS) -> Column:
    """True when none of the given quality bits is set."""
    mask = reduce(lambda m, b: m | (1 << b), bits, 0)
    return qa.bitwiseAND(F.lit(mask)) == 0


def clear_class(scl: Column, masked=SCENE_CLASSES_MASKED) -> Column:
    return ~scl.isin(*masked)


def radar_pair(vv: Column, vh: Column) -> tuple[Column, Column, Column, Column]:
    """VV, VH and VV-VH in dB, all NULL unless both are present, and the joint flag."""
    joint = vv.isNotNull() & vh.isNotNull()
    return F.when(joint, vv), F.when(joint, vh), F.when(joint, vv - vh), joint
