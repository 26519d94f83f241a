"""Driver-side adapters: running a command, and exporting a repository folder with a command-line client."""

from __future__ import annotations

import os
import subprocess
from dataclasses import dataclass, field
from pathlib import Path


class CommandError(RuntimeError):
    pass


def run_command(cmd: list[str], env: dict[str, str] | None = None, cwd: str | None = None, timeout_s: float | None = None, check: bool = True) -> subprocess.CompletedProcess:
    done = subprocess.run(cmd, env={**os.environ, **(env or {})}, cwd=cwd, timeout=timeout_s, capture_output=True, text=True)
    if check and done.returncode:
        raise CommandError(f"{cmd[0]} ended with {done.returncode}\n{done.stdout}\n{done.stderr}")
    return done


@dataclass
class FolderExport:
    """Connect, export one folder to a file, and disconnect whatever happens; an existing file is kept unless overwrite.

    The password goes by the name of its environment variable, so that no process list shows it."""

    bin_path: str
    domain: str
    repo: str
    user: str
    password_env: str
    folder: str
    output: str
    overwrite: bool = False
    connect_timeout_s: float = 60
    export_timeout_s: float = 600
    extra_env: dict[str, str] = field(default_factory=dict)

    def run(self, command=run_command) -> str:
        if Path(self.output).exists() and not self.overwrite:
            return self.output
        password = os.environ.get(self.password_env)
        if not password:
            raise CommandError(f"environment variable {self.password_env} is not set")
        env = {**self.extra_env, self.password_env: password}
        command([self.bin_path, "connect", "-d", self.domain, "-r", self.repo, "-n", self.user, "-X", self.password_env], env=env, timeout_s=self.connect_timeout_s)
        try:
            Path(self.output).parent.mkdir(parents=True, exist_ok=True)
            command([self.bin_path, "objectexport", "-f", self.folder, "-p", self.output, "-o", "Folder", "-n", self.folder], env=env, timeout_s=self.export_timeout_s)
        finally:
            command([self.bin_path, "disconnect"], env=env, timeout_s=self.connect_timeout_s, check=False)
        return self.output
