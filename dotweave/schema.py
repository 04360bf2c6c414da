"""Column types of the tables that move between stages, and the codes of failed registrations."""

from __future__ import annotations

IMAGES = (
    "experiment_name string, experiment_type string, machine string, channel string, stitching_channel string, target_name string, "
    "processing_type string, codebook string, fov_num int, round_num int, zstack int, total_fovs int, total_rounds int, img_width int, img_height int, "
    "overlapping_percentage int, barcode boolean, barcode_length int, pixel_microns double, fov_acquisition_coords_x double, "
    "fov_acquisition_coords_y double, fov_acquisition_coords_z double, grp_name string, raw_data_location string"
)
PIXELS = "fov_num int, channel string, round_num int, shape array<int>, dtype string, pixels binary"
DOTS = (
    "dot_id string, fov_num int, round_num int, channel string, r_px_original double, c_px_original double, "
    "dot_intensity double, selected_thr double, mapped_beads_type string"
)
SHIFTS = "fov_num int, round_num int, dr double, dc double, n_match int"
DECODED = "fov_num int, channel string, barcode_reference_dot_id string, round_num int, r double, c double, code_bits long"
PAIR_SHIFTS = "a int, b int, dr double, dc double, err double"

#: Matching-dot counts that stand for a failed registration.
ERRORS = {
    "too_few_matches": -2,
    "missing_in_round": -3,
    "missing_in_reference_round": -4,
    "missing_in_registration_channel": -5,
    "missing_in_fish_channel": -6,
}
#: The count of the reference round itself.
REFERENCE_MATCHES = 1000
