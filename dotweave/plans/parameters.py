"""Default analysis parameters, and their selection by kind of image.

A parameter file (see sources.catalogs.config) overrides any of them, by experiment and machine.
"""

from __future__ import annotations

# The usual settings of each kind of image.
DEFAULTS: dict = {
    "fish": {
        "PreprocessingFishFlatFieldKernel": (1, 100, 100),
        "PreprocessingFishFilteringSmallKernel": (1, 8, 8),
        "PreprocessingFishFilteringLaplacianKernel": (0.02, 0.01, 0.01),
        "CountingFishMinObjDistance": 1,
        "CountingFishMaxObjSize": 200,
        "CountingFishMinObjSize": 1,
        "CountingFishNumPeaksPerLabel": 20,
        "LargeObjRemovalPercentile": 95,
        "LargeObjRemovalMinObjSize": 100,
        "LargeObjRemovalSelem": 3,
    },
    "both-beads": {
        "PreprocessingFishFlatFieldKernel": (1, 100, 100),
        "PreprocessingFishFilteringSmallKernel": (1, 8, 8),
        "PreprocessingFishFilteringLaplacianKernel": (0.02, 0.01, 0.01),
        "CountingFishMinObjDistance": 5,
        "CountingFishMaxObjSize": 600,
        "CountingFishMinObjSize": 10,
        "CountingFishNumPeaksPerLabel": 1,
        "LargeObjRemovalPercentile": 95,
        "LargeObjRemovalMinObjSize": 100,
        "LargeObjRemovalSelem": 3,
    },
    "staining": {"PreprocessingStainingFlatFieldKernel": (2, 100, 100)},
    "fresh-nuclei": {"PreprocessingFreshNucleiLargeKernelSize": (5, 50, 50)},
    "fresh-beads": {
        "PreprocessingFishFlatFieldKernel": (100, 100),
        "CountingFishMinObjDistance": 20,
        "CountingFishMaxObjSize": 200,
        "CountingFishMinObjSize": 20,
        "CountingFishNumPeaksPerLabel": 1,
    },
    "BarcodesExtractionResolution": 2,
    "RegistrationReferenceHybridization": 1,
    "RegistrationTollerancePxl": 3,
    "RegistrationMinMatchingBeads": 5,
}


def selected(kind: str, overrides: dict | None = None) -> dict:
    """The parameters of one kind of image and the general ones, with ``overrides`` of the same shape on top."""
    general = {k: v for k, v in DEFAULTS.items() if not isinstance(v, dict)}
    if kind not in DEFAULTS:
        raise ValueError(f"no parameters for {kind!r}")
    more = overrides or {}
    return general | {k: v for k, v in more.items() if not isinstance(v, dict)} | DEFAULTS[kind] | more.get(kind, {})
