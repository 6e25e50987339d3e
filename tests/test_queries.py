import importlib

import pytest

import __spark_entry__ as entry
from tests.oracle import differences

NAMES = [
    "p1_found", "p3_found", "p3_counts", "p4_found", "p4_index", "p4_records", "p5_found", "p5_motion_totals", "rot_quaternion_algebra", "rot_sixd_to_matrix", "rot_facing_yaw", "sk_edge_relations", "sk_level_order", "sk_validate",
    "ft_group_statistics", "ft_world_positions", "ft_foot_contacts", "ft_forward_kinematics", "ft_crop_or_pad", "qa_gate_a", "qa_gate_e", "qa_repaired_statistics", "mt_nearest_frames", "mt_nearest_vectors", "df_sampling_steps", "df_respaced",
    "mf_tiered_match", "mf_best_alias", "mf_names", "sm_batches", "sm_with_midpoint", "src_bvh_round_trip", "st_running_counts",
    "p1_sources", "p4_containers", "p4_blocks", "qa_gate_c", "qa_build_report", "mt_character_table", "ft_decoded_clips", "ft_expanded_rig", "ft_relative_positions", "rot_euler_angles", "rot_more_forms", "rot_inverses", "rot_affine_inverse", "rot_random",
    "df_model_terms", "df_training_loss", "df_sampled_inpainting", "ct_pair_mask", "ct_padded_relation", "ct_padded_statistics", "ct_augmentation", "ct_collated", "ct_tokens", "mf_pooled_paths", "mf_source_keys", "mf_caption_records", "mf_processed_index",
    "mf_chosen", "mf_mapped", "mf_resolved", "mf_selections", "mf_file_names", "mf_raw_stems", "sk_declared_joints", "qa_vertex_summary", "sm_weighted_rotations", "sm_smoothed",
]


@pytest.fixture(scope="module")
def core():
    modules = [importlib.import_module(m) for m in entry.MODULES]
    return {k: v for m in modules for k, v in m.QUERIES.items()}, {k: v for m in modules for k, v in m.ORACLE.items()}


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_its_sql(spark, core, name):
    assert differences(spark, core[0][name], core[1][name]) == ([], [])
