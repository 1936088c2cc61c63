"""Declared inputs of the plant tables: file name, headers, target names and types."""

from __future__ import annotations

from ..sources.spec import Field, TableSpec, fields

PATH_FIELDS = ("Enterprise", "Site", "Plant", "ProcessCell:process_cell", "Unit")
ORDER_FIELD = "ProcessOrderNo:process_order_number"

AVAILABILITY = TableSpec(
    fields(
        *PATH_FIELDS,
        "RecId:recid:int",
        "EventTime:event_time:timestamp",
        Field("ProcessOrderNo", "process_order_number", default=""),
        "TargetProdRate:target_prod_rate:double",
        "Shift",
        "RunningState:running_state",
        Field("Reason", "reason", default=""),
        Field("ReasonGroupDesc1", "reason_group_desc_1", default=""),
        Field("ReasonGroupDesc2", "reason_group_desc_2", missing=("NULL",), default=""),
        "Category",
        "Comment:explanation",
        "StepDesc:step_description",
        "StepNumber:step_number:int",
        "TargetDuration:target_duration:int",
        "ReleaseTS:releasets",
        "IsProcessed:isprocessed:boolean",
    )
)
RATE = TableSpec(
    fields(
        *PATH_FIELDS,
        "RecId:recid:int",
        Field("ProcessOrderNo", "process_order_number", default=""),
        "StartTS:start_ts:timestamp",
        "Capacity:capacity:double",
        "QuantityProd:quantity_prod:double",
        "QuantityGood:quantity_good:double",
        "TargetProdRate:target_prod_rate:double",
        "RunTime:runtime_sec:int",
        "DownTime:downtime_sec:int",
        "ReleaseTS:releasets",
        "IsProcessed:isprocessed:boolean",
    )
)
ORDERS = TableSpec(
    fields(
        *PATH_FIELDS,
        Field("ProcessOrderNo", "process_order_number", default=""),
        "ProductId:productid",
        Field("MaterialGrade", "material_grade", default=""),
        Field("MaterialColor", "material_color", default=""),
        "LogsheetNum:logsheet_number",
        "QuantityProd:quantity_prod:double",
        "TargetProdRate:target_prod_rate:double",
        "ActualStartTime:actual_start_time:timestamp",
        "ActualEndTime:actual_end_time:timestamp",
        "QuantityRequired:quantity_required:double",
        "QuantityProd_ERP:quantity_prod_erp:double",
        "FTR_ERP:ftr_erp:double",
        "FTR_Perc:ftr_pct:double",
        "RawMaterials_ERP:raw_materials_erp:double",
        "Blocked_ERP:blocked_erp:double",
        "Rework_ERP:rework_erp:double",
        "Scrap_ERP:scrap_erp:double",
        "Obsolete_ERP:obsolete_erp:double",
        "IntraMaterial_ERP:intra_material_erp:double",
        "FreeForUse_ERP:free_for_use_erp:double",
        "TargetRate:target_rate:double",
        "TargetAvailability:target_availability:double",
        "TargetQuality:target_quality:double",
        "TargetSetupTime:target_setup_time:double",
        "DefaultValuesUsed:default_values_used:boolean",
        "Bottleneck:bottleneck:boolean",
        "ReleaseTS:releasets",
        "IsProcessed:isprocessed:boolean",
    )
)
READINGS = TableSpec(
    fields(
        *PATH_FIELDS,
        ORDER_FIELD,
        "ReleaseTS:releasets:timestamp",
        "ve_machine",
        "MaterialNumber:materialnumber",
        "ve_materialdescription",
        "ve_bom:ve_bom:double",
        "ve_quantityproduced:ve_quantityproduced:double",
        "ve_dosedfeeders:ve_dosedfeeders:double",
        "ve_dosedscanned:ve_dosedscanned:double",
        "ve_check:ve_check:boolean",
        "ve_explanation",
        "ve_remark",
    )
)
ALARMS = TableSpec(
    fields(
        *PATH_FIELDS,
        "KOP:kop",
        "HourStartTS:hourstartts:timestamp",
        "EventTS:eventts:timestamp",
        "EventType:eventtype",
        ORDER_FIELD,
        "Interval:interval:int",
        "KOPActived:kop_activated:int",
        "AlarmDuration:alarm_duration:int",
        "AlarmText:alarm_text",
        "ReleaseTS:releasets:timestamp",
    )
)
MOVEMENTS = TableSpec(
    fields(
        "MBLNR", "ZEILE", "BWART", "XAUTO", "MATNR", "WERKS", "LGORT", "CHARG", "SHKZG", "MENGE:menge:double",
        "MEINS", "ERFMG:erfmg:double", "ERFME", "AUFNR", "PBAMG:pbamg:double", "UMMAT", "UMWRK", "UMLGO", "UMCHA",
        "KZBEW", "KZVBR", "KZZUG", "WEUNB", "BUDAT_MKPF:budat_mkpf:date", "CPUDT_MKPF:cpudt_mkpf:date",
        "CPUTM_MKPF", "USNAM_MKPF", "INSMK",
        *[Field(name, name.lower(), optional=True) for name in ("BWTAR", "EQUNR", "UMBAR", "BWLVS")],
    )
)
UNITS = TableSpec(
    fields(*PATH_FIELDS, "default_bottleneck:default_bottleneck:boolean", "MPC:mpc:int")
)
CATEGORIES = TableSpec(
    fields(
        "Enterprise", "Site",
        *[
            Field(h, n, missing=("nan",), default="")
            for h, n in (
                ("Reason", "reason"),
                ("reason_group_desc_1", "reason_group_desc_1"),
                ("reason_group_desc_2", "reason_group_desc_2"),
                ("oee_category", "oee_category"),
                ("iscosted", "iscosted"),
            )
        ],
    )
)
SHIFTS = TableSpec(fields("Shift", "Modulo:shift_modulo:int", "shift_letter"))
SETTINGS = TableSpec(fields("Site", "Start Date:start_date_text"))

LINE_FILES = {
    "availability": ("availabilitydata_rpt.csv", AVAILABILITY),
    "rate": ("ratedata_rpt.csv", RATE),
    "orders": ("podata_rpt.csv", ORDERS),
    "readings": ("vareffdata_rpt.csv", READINGS),
    "alarms": ("opndata_rpt.csv", ALARMS),
    "movements": ("movements.csv", MOVEMENTS),
    "units": ("units.csv", UNITS),
    "categories": ("categories.csv", CATEGORIES),
    "shifts": ("shifts.csv", SHIFTS),
}

BATCH_FILES = {
    "duration": (
        "Duration.csv",
        TableSpec(
            fields(
                "Id:durationid:int", "Actual:durationactual:int", "Cost:durationcost:double",
                "Loss:durationloss:int", "Target:durationtarget:int", "GM:durationgm:double",
            )
        ),
    ),
    "explanation": (
        "Explanation.csv",
        TableSpec(
            fields(
                "Id:explanationid:int", "Instance:explanationinstance:int", "Loss:explanationloss:int",
                "Cost:explanationcost:double", "Category:explanationcategory",
                "Subcategory:explanationsubcategory", "Group:explanationgroup", "Remark:explanationremark",
                "DurationId:durationid:int",
            )
        ),
    ),
    "operation": (
        "Operation.csv",
        TableSpec(
            fields(
                "Id:operationid:int", "Unit_ProcedureId:unit_procedureid:int", "Start:operationstart:timestamp",
                "End:operationend:timestamp", "Name:step_description",
            )
        ),
    ),
    "operation_duration": (
        "Operation Duration.csv",
        TableSpec(fields("OperationId:operationid:int", "DurationId:durationid:int")),
    ),
    "procedure": (
        "Procedure.csv",
        TableSpec(
            fields(
                "Id:procedureid:int", "Area:procedurearea", "Production Order:process_order_number",
                "Product Name:productid", "Product Group:procedureproduct_group",
                "Recipe Code:procedurerecipe_code", "Start:procedurestart:timestamp", "End:procedureend:timestamp",
            )
        ),
    ),
    "unit_procedure": (
        "Unit procedure.csv",
        TableSpec(
            fields(
                "Id:unit_procedureid:int", "ProcedureId:procedureid:int", "Name:unit_procedurename", "Unit",
                "Start:unit_procedurestart:timestamp", "End:unit_procedureend:timestamp",
                "ReactorVolume:unit_procedurereactorvolume:double",
            )
        ),
    ),
    "yield": (
        "Yield.csv",
        TableSpec(
            fields(
                "Id:yieldid:int", "ProcedureId:procedureid:int", "Actual:yieldactual:double", "Cost:yieldcost:double",
                "Loss:yieldloss:double", "Target:yieldtarget:double",
            )
        ),
    ),
    "operations": (
        "operations.csv",
        TableSpec(fields("Step Description:step_description", "Type:operationtype", "Step Number:step_number:int")),
    ),
    "reporting_categories": (
        "reporting_categories.csv",
        TableSpec(
            fields(
                "Category:explanationcategory", "Subcategory:explanationsubcategory", "Group:explanationgroup",
                "Reporting Category:oee_category",
            )
        ),
    ),
    "equipment": (
        "equipment.csv",
        TableSpec(
            fields(
                "ProcedureArea:procedurearea", "Unit:unit", "Enterprise", "Site", "Plant", "Process Cell:process_cell",
                "Bottleneck:bottleneck:boolean", "MPC:mpc:int",
            )
        ),
    ),
    "movements": ("movements.csv", MOVEMENTS),
}
BATCH_FACTS = [
    "duration", "explanation", "operation", "operation_duration", "procedure", "unit_procedure", "yield",
]
