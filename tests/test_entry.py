import subprocess
import sys

import __spark_entry__ as entry


def test_names_agree():
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries) and len(queries) > 100
    assert {f"p{n}_found" for n in (1, 3, 4, 5)} <= set(queries)


def test_core_does_not_import_the_llm_package():
    code = "import sys, __spark_entry__ as e; [__import__(m) for m in e.MODULES]; import stridelake.streaming.progress, stridelake.sources.bvh; sys.exit(any(m.startswith('stridelake.llm') for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code]).returncode == 0


def test_queries_stand_without_a_package_that_only_llm_needs():
    code = "import sys; sys.modules['regex'] = None; import __spark_entry__ as e; q = e.queries(); sys.exit(not ('p1_found' in q and 'p7_found' not in q))"
    assert subprocess.run([sys.executable, "-c", code]).returncode == 0


def test_scans_are_pruned_and_plans_stay_in_the_jvm(spark):
    sf = "/root/testdata/sf0.001"
    plan = entry.queries()["ft_group_statistics"](spark, sf)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(object_type)" in plan and "ReadSchema: struct<object_type:string,motion_id:string,frame:int,joint:int,f:array<float>>" in plan
    for name in ("ft_group_statistics", "ft_world_positions", "rot_sixd_to_matrix", "qa_gate_a", "mf_alignment_status", "df_sampling_steps"):
        plan = entry.queries()[name](spark, sf)._jdf.queryExecution().toString()
        assert "Python" not in plan.split("== Physical Plan ==")[1].replace("PythonUDF", "Python") or "MapInArrow" in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
