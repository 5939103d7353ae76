"""Schemas of captured documents and sheets."""

from __future__ import annotations

IMAGE_INSPECT = """struct<
  Id:string, RepoTags:array<string>, RepoDigests:array<string>, Created:string, Size:bigint,
  VirtualSize:bigint, Architecture:string, Os:string, RootFS:struct<Layers:array<string>>,
  Config:struct<User:string, WorkingDir:string, Env:array<string>, Cmd:array<string>,
    Entrypoint:array<string>, Labels:map<string,string>, ExposedPorts:map<string,string>,
    Healthcheck:struct<Test:array<string>>>>"""

CONTAINER_INSPECT = """struct<
  Id:string, Name:string,
  State:struct<Running:boolean, Health:struct<Status:string>>,
  Config:struct<User:string>,
  HostConfig:struct<RestartPolicy:struct<Name:string>, Privileged:boolean, Memory:bigint,
    LogConfig:struct<Type:string>>,
  NetworkSettings:struct<Ports:map<string,array<struct<HostIp:string,HostPort:string>>>>>"""

IMAGE_LISTING = "struct<ID:string, Repository:string, Tag:string, Digest:string, Size:string, CreatedAt:string>"
CONTAINER_LISTING = "struct<ID:string, Names:string, Image:string, State:string, Status:string>"
HISTORY_ENTRY = "struct<ID:string, CreatedBy:string, Size:string, Comment:string, CreatedAt:string>"
CODE_SEARCH_PAGE = "struct<items:array<struct<html_url:string, stargazers_count:bigint, fork:boolean>>>"
COMPLETION_CHUNK = "struct<id:string, created:bigint, choices:array<struct<text:string, index:int, finish_reason:string>>>"

PULL_REQUEST = (
    "Project string, PNumber int, CreatedAt string, ClosedAt string, isMerged string, MergedAt string, "
    "MergedCommit string, nFiles int, nCommits int, Commits string, Labels string, Title string, Body string"
)
ANNOTATION_QUESTIONS = ("is_challenge", "is_specific", "bad_practice", "challenge", "mitigation", "restructuring")
