"""The eight tables: schemas and job settings, as data.

Raw contracts keep the export's own names; clean contracts are the same fields
under standardised names. Ids are 64-bit throughout so that keys of different
tables join without casts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from ..operators.columns import standardize_column_names


def _names(text: str) -> tuple[str, ...]:
    return tuple(text.split())


@dataclass(frozen=True)
class TableSpec:
    """One table of the pipeline.

    ``raw_ddl`` lists the export's columns. Column names in the settings are
    clean names. ``null_columns`` have sentinel text turned into NULL;
    ``iso_columns`` and all other timestamps are published as ISO text;
    ``outlier_columns`` enter the outlier check; ``clamped`` timestamps lose years outside
    1-9999; ``allowed`` is an allow-list ``(column, values)``; ``filled_flag`` adds
    ``has_<column>``; ``dropped`` and ``redacted`` belong to de-identification.
    """

    dataset: str
    table: str
    raw_file: str
    raw_ddl: str
    keys: tuple[str, ...]
    null_columns: tuple[str, ...]
    iso_columns: tuple[str, ...]
    outlier_columns: tuple[str, ...]
    multiline: bool = False
    clamped: tuple[str, ...] = ()
    allowed: tuple[str, tuple[str, ...]] | None = None
    filled_flag: str | None = None
    dropped: tuple[str, ...] = ()
    redacted: tuple[str, ...] = ()

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.raw_ddl)

    @property
    def clean_schema(self) -> T.StructType:
        raw = self.raw_schema
        clean = T.StructType(
            [
                T.StructField(name, field.dataType)
                for name, field in zip(standardize_column_names(raw.names), raw)
            ]
        )
        if self.filled_flag:
            clean = clean.add(f"has_{self.filled_flag}", "boolean")
        return clean

    @property
    def published_schema(self) -> T.StructType:
        """Clean contract without the columns de-identification drops."""
        kept = [f for f in self.clean_schema if f.name not in self.dropped]
        return T.StructType(kept)


# The columns and settings of each table.

CONTENT_OBJECTS = TableSpec(
    dataset="contentdata",
    table="contentobjects",
    raw_file="Content/ContentObjects.csv",
    raw_ddl="""
        ContentObjectId bigint, OrgUnitId bigint, Title string,
        ContentObjectType string, CompletionType string,
        ParentContentObjectId bigint, Location string, StartDate timestamp,
        EndDate timestamp, DueDate timestamp, ObjectId1 bigint, ObjectId2 bigint,
        ObjectId3 bigint, LastModified timestamp, IsDeleted boolean, SortOrder int,
        Depth int, ToolId int, IsHidden boolean, ResultId bigint,
        DeletedDate timestamp, CreatedBy bigint, LastModifiedBy bigint,
        DeletedBy bigint, AIUtilization int
    """,
    keys=_names("content_object_id"),
    null_columns=_names("title content_object_type completion_type location"),
    iso_columns=_names("start_date end_date due_date last_modified deleted_date"),
    outlier_columns=_names("sort_order depth ai_utilization"),
    clamped=_names("start_date end_date due_date last_modified deleted_date"),
    allowed=("completion_type", ("Auto", "Manual", "Topic", "Module")),
    dropped=_names("created_by last_modified_by deleted_by title location"),
    redacted=_names("content_object_type completion_type"),
)

AUDIO_VIDEO = TableSpec(
    dataset="contentservice",
    table="audiovideoprocessed",
    raw_file="ContentService/AudioVideoProcessed.csv",
    raw_ddl="""
        ContentId string, RevisionId string, RevisionNumber int, Type string,
        Source string, RevisionSize bigint, Duration int,
        RequiredTranscoding boolean, RequiredTranscribing boolean,
        LastModified timestamp
    """,
    keys=_names("content_id revision_id"),
    null_columns=_names("content_id revision_id"),
    iso_columns=_names("last_modified"),
    outlier_columns=_names("revision_number revision_size duration"),
    redacted=_names("content_id revision_id type source"),
)

DISCUSSION_FORUMS = TableSpec(
    dataset="discussions",
    table="discussionforums",
    raw_file="DiscussionsForum/DiscussionForums.csv",
    raw_ddl="""
        OrgUnitId bigint, ForumId bigint, Name string, Description string,
        MustPostToParticipate boolean, AllowAnon boolean, IsHidden boolean,
        RequiresApproval boolean, SortOrder int, IsDeleted boolean,
        DeletedDate timestamp, DeletedByUserId bigint, ResultId bigint,
        StartDate timestamp, StartDateAvailabilityType int, EndDate timestamp,
        EndDateAvailabilityType int
    """,
    keys=_names("org_unit_id forum_id"),
    null_columns=_names("name description"),
    iso_columns=_names("deleted_date start_date end_date"),
    outlier_columns=_names(
        "org_unit_id forum_id sort_order deleted_by_user_id result_id "
        "start_date_availability_type end_date_availability_type"
    ),
    multiline=True,
    filled_flag="description",
    dropped=_names("deleted_by_user_id description name"),
)

GRADE_OBJECTS = TableSpec(
    dataset="grades",
    table="gradeobjects",
    raw_file="GradeObjects/GradeObjects.csv",
    raw_ddl="""
        GradeObjectId bigint, OrgUnitId bigint, ParentGradeObjectId bigint,
        Name string, TypeName string, StartDate timestamp, EndDate timestamp,
        IsAutoPointed boolean, IsFormula boolean, IsBonus boolean,
        MaxPoints double, CanExceedMaxGrade boolean,
        ExcludeFromFinalGradeCalc boolean, GradeSchemeId bigint, Weight double,
        NumLowestGradesToDrop int, NumHighestGradesToDrop int,
        WeightDistributionType string, CreatedDate timestamp, ToolName string,
        AssociatedToolItemId bigint, LastModified timestamp, ShortName string,
        GradeObjectTypeId int, SortOrder int, IsDeleted boolean,
        DeletedDate timestamp, DeletedByUserId bigint, ResultId bigint,
        ToolId int, Version bigint
    """,
    keys=_names("grade_object_id"),
    null_columns=_names(
        "name type_name weight_distribution_type tool_name short_name"
    ),
    iso_columns=_names("start_date end_date created_date last_modified deleted_date"),
    outlier_columns=_names(
        "grade_object_id org_unit_id parent_grade_object_id max_points "
        "grade_scheme_id weight num_lowest_grades_to_drop "
        "num_highest_grades_to_drop associated_tool_item_id grade_object_type_id "
        "sort_order deleted_by_user_id result_id tool_id version"
    ),
    dropped=_names("deleted_by_user_id name short_name"),
    redacted=_names("type_name weight_distribution_type tool_name"),
)

ORG_UNITS = TableSpec(
    dataset="organizationalunits",
    table="organizationalunits",
    raw_file="OrganizationalUnits/OrganizationalUnits.csv",
    raw_ddl="""
        OrgUnitId bigint, Organization string, Type string, Name string,
        Code string, StartDate timestamp, EndDate timestamp, IsActive boolean,
        CreatedDate timestamp, IsDeleted boolean, DeletedDate timestamp,
        RecycledDate timestamp, Version bigint, OrgUnitTypeId int
    """,
    keys=_names("org_unit_id"),
    null_columns=_names("name code"),
    iso_columns=_names("start_date end_date"),
    outlier_columns=_names("org_unit_id version org_unit_type_id"),
    dropped=_names("name code"),
    redacted=_names("type organization"),
)

QUIZ_OBJECTS = TableSpec(
    dataset="quizzes",
    table="quizobjects",
    raw_file="QuizObjects/QuizObjects.csv",
    raw_ddl="""
        QuizId bigint, QuizName string, QuizDescription string,
        QuizCategory string, IsActive boolean, OrgUnitId bigint,
        StartDate timestamp, EndDate timestamp, DueDate timestamp,
        CreationDate timestamp, CreatedBy bigint, LastModified timestamp,
        LastModifiedBy bigint, GradeObjectId bigint,
        OverallScoreCalculation string, QuizScoreDenominator double,
        HasPassword boolean, IPRestricted boolean, TimeLimit int,
        TimeLimitEnforced boolean, AttemptsAllowed int,
        PreventMovingBackwards boolean, AllowHints boolean,
        NotificationEmail string, DisablePagerAccess boolean,
        DisplayInCalendar boolean, IsAttemptRldb boolean, IsSubviewRldb boolean,
        SortOrder int, CategoryId bigint, ResultId bigint,
        IsRetakeIncorrectOnly boolean, PagingTypeId int, IsSynchronous boolean,
        DeductionPercentage string, AIStudySupport boolean,
        HideQuestionPoints boolean
    """,
    keys=_names("quiz_id"),
    null_columns=_names(
        "quiz_name quiz_description quiz_category overall_score_calculation "
        "notification_email deduction_percentage"
    ),
    iso_columns=_names("start_date end_date due_date creation_date last_modified"),
    outlier_columns=_names(
        "quiz_id org_unit_id created_by last_modified_by grade_object_id "
        "quiz_score_denominator time_limit attempts_allowed sort_order category_id "
        "result_id paging_type_id"
    ),
    multiline=True,
    filled_flag="quiz_description",
    dropped=_names(
        "notification_email created_by last_modified_by quiz_description quiz_name "
        "quiz_category"
    ),
    redacted=_names("overall_score_calculation deduction_percentage"),
)

RELEASE_CONDITIONS = TableSpec(
    dataset="releaseconditions",
    table="releaseconditionsobjects",
    raw_file="ReleaseConditionsObjects/ReleaseConditionObjects.csv",
    raw_ddl="""
        PreRequisiteId bigint, ResultId bigint, OrgUnitId bigint, Name string,
        IsNegativeCondition boolean, PreRequisiteToolId int, Id1 bigint,
        Id2 bigint, ResultToolId int, UsesPercentage boolean,
        OperatorTypeDesc string, Version bigint, Guid1 string, Guid2 string
    """,
    keys=_names("pre_requisite_id result_id org_unit_id"),
    null_columns=_names("name operator_type_desc guid1 guid2"),
    iso_columns=(),
    outlier_columns=_names(
        "pre_requisite_id result_id org_unit_id pre_requisite_tool_id id1 id2 "
        "result_tool_id version"
    ),
    redacted=_names("name operator_type_desc guid1 guid2"),
)

ROLE_DETAILS = TableSpec(
    dataset="roledetails",
    table="roledetails",
    raw_file="RoleDetails/RoleDetails.csv",
    raw_ddl="""
        OrgUnitId bigint, RoleId bigint, RoleName string, Description string,
        IsCascading boolean, InClassList boolean, ClassListRoleName string,
        ClassListShowGroups boolean, ClassListShowSections boolean,
        ClassListDisplayRole boolean, AccessInactiveCO boolean,
        HasSpecialAccess boolean, AddToCourseOfferingGroups boolean,
        CanBeAutoEnrolledIntoGroups boolean, AddToCourseOfferingSections boolean,
        CanBeAutoEnrolledIntoSections boolean, AccessPastCourses boolean,
        AccessFutureCourses boolean, SortOrder int, ShowInContent boolean,
        ShowInDiscussionAssess boolean, ShowInDiscussionStats boolean,
        ShowInGrades boolean, ShowInAttendance boolean,
        AllowSelfEnrollInGroups boolean, ShowInRegistration boolean,
        ShowInUserProgress boolean, RoleAlias string, RoleCode string,
        LastModifiedDate timestamp, DeletedBy bigint
    """,
    keys=_names("org_unit_id role_id"),
    null_columns=_names("description class_list_role_name role_alias role_code"),
    iso_columns=(),
    outlier_columns=_names("org_unit_id role_id sort_order deleted_by"),
    dropped=_names("deleted_by role_name"),
    redacted=_names("description class_list_role_name role_alias role_code"),
)

TABLES = {
    spec.table: spec
    for spec in (
        AUDIO_VIDEO,
        CONTENT_OBJECTS,
        DISCUSSION_FORUMS,
        GRADE_OBJECTS,
        ORG_UNITS,
        QUIZ_OBJECTS,
        RELEASE_CONDITIONS,
        ROLE_DETAILS,
    )
}
