"""Column names and types of the input files."""

from __future__ import annotations

# Policy columns used as features, in feature order.
POLICY_FEATURES = [
    "Exposure", "Area", "VehPower", "VehAge", "DrivAge",
    "BonusMalus", "VehBrand", "VehGas", "Density", "Region",
]

# Names given to the particle columns by position.
PARTICLE_COLUMNS = [
    "label", "lepton_pT", "lepton_eta", "lepton_phi", "missing_energy_magnitude",
    "missing_energy_phi", "jet_1_pt", "jet_1_eta", "jet_1_phi", "jet_1_b-tag",
    "jet_2_pt", "jet_2_eta", "jet_2_phi", "jet_2_btag", "jet_3_pt", "jet_3_eta",
    "jet_3_phi", "jet_3_btag", "jet_4_pt", "jet_4_eta", "jet_4_phi", "jet_4_btag",
    "mjj", "mjjj", "mlv", "mjlv", "mbb", "mwbb", "mwwbb",
]
PARTICLE_FEATURES = PARTICLE_COLUMNS[1:]

POLICIES_CSV = (
    "IDpol bigint, ClaimNb int, Exposure double, Area string, VehPower int, VehAge int, "
    "DrivAge int, BonusMalus int, VehBrand string, VehGas string, Density int, Region string"
)
PARTICLES_CSV = ", ".join(f"`{name}` double" for name in PARTICLE_COLUMNS)
RATINGS_CSV = "userId int, movieId int, rating double, timestamp bigint"
MOVIES_CSV = "movieId int, title string, genres string"
